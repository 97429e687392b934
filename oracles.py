"""The registered queries in DuckDB SQL, over the same tables.

Each is worked out from the tables on its own: inputs that the Spark side first wraps in
HTML or JSON and then parses are read here straight from the text lines.
"""

from __future__ import annotations

from rolecall.functions import constants as K
from rolecall.functions import text as T


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(number: str, *choices: str) -> str:
    whens = " ".join(f"WHEN {at} THEN {c}" for at, c in enumerate(choices))
    return f"(CASE ({number}) % {len(choices)} {whens} END)"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _slug(x: str) -> str:
    kept = rf"regexp_replace({_trim(f'lower({x})')}, '[^\p{{L}}\p{{N}}_\s-]', '', 'g')"
    return rf"left(regexp_replace({kept}, '[\s_-]+', '_', 'g'), {K.KEY_CHARS})"


# --- URLs -----------------------------------------------------------------------------

VARIANTS = f"""
variants_wide AS (
  SELECT page_id, regexp_extract(url, '//[^/]+/([a-z]+)/', 1) AS company,
    [url, b || '/apply', b || '/apply/?src=a&b=1&b=2&c=&UTM_SOURCE=q&d&e=x=y',
     b || '?q=a+b%2Fc&t=~*&bad=%25zz&pid=9&n=caf%C3%A9#frag',
     'https://boards.greenhouse.io/' || co || '/jobs/' || page_id || '?gh=x&ref=y',
     'http://jobs.lever.co/' || co || '/' || page_id || '/apply',
     'https://' || co || '.wd5.myworkdayjobs.com/en/job/' || page_id || '/apply/',
     regexp_replace(b, '^https?://', '')] AS us
  FROM (SELECT *, split_part(split_part(url, '#', 1), '?', 1) AS b, 'co' || (page_id % 50) AS co FROM pages)),
variants AS (
  SELECT page_id, company, unnest(us) AS url, generate_subscripts(us, 1) - 1 AS variant FROM variants_wide)"""

CANONICAL = rf"""
cut AS (
  SELECT *, split_part(url, '#', 1) AS base, strpos(url, '#') AS hash FROM variants),
parts AS (
  SELECT *, split_part(base, '?', 1) AS located,
    CASE WHEN strpos(base, '?') > 0 THEN substr(base, strpos(base, '?') + 1) ELSE '' END AS qs,
    CASE WHEN hash > 0 AND length(url) > hash THEN substr(url, hash) ELSE '' END AS frag FROM cut),
items AS (
  SELECT *, regexp_replace(regexp_replace(located, '^[A-Za-z][A-Za-z0-9+.\-]*:', ''), '/apply/?$', '') AS tail,
    list_transform(
      list_filter(string_split(qs, '&'), lambda p: regexp_matches(p, '=.')),
      lambda p: struct_pack(
        k := url_decode(replace(split_part(p, '=', 1), '+', ' ')),
        v := url_decode(replace(substr(p, strpos(p, '=') + 1), '+', ' ')))) AS kv FROM parts),
kept AS (
  SELECT *, list_filter(kv, lambda x, i: x.k NOT IN {_in(K.TRACKING_PARAMS)}
      AND list_position(list_transform(kv, lambda y: y.k), x.k) = i) AS good FROM items),
canon AS (
  SELECT page_id, variant, company, url,
    'https:' || CASE WHEN tail LIKE '/%' OR tail = '' THEN '' ELSE '' END || tail
    || CASE WHEN len(good) > 0 THEN '?' || array_to_string(list_transform(good, lambda x:
        replace(url_encode(x.k), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')), '&') ELSE '' END
    || frag AS canonical_url FROM kept)"""

_HOST = r"regexp_extract(canonical_url, '^https://([^/?#]*)', 1)"
PLATFORM = f"""CASE WHEN {_HOST} LIKE '%greenhouse.io%' THEN 'greenhouse'
  WHEN {_HOST} LIKE '%lever.co%' THEN 'lever'
  WHEN {_HOST} LIKE '%myworkdayjobs.com%' OR {_HOST} LIKE '%workday.com%' THEN 'workday' ELSE 'generic' END"""

VOTES = rf"""
hosts AS (
  SELECT company, page_id * 10 + variant AS hit_rank,
    regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\.', '') AS h FROM variants),
roots AS (SELECT *, array_to_string(string_split(h, '.')[-2:], '.') AS domain FROM hosts WHERE h <> ''),
votes AS (
  SELECT company, domain, count(*) AS votes, min(hit_rank) AS first_rank FROM roots
  WHERE domain NOT IN {_in(K.BOARD_DOMAINS)} GROUP BY ALL)"""

_KEY = "regexp_replace(lower(canonical_url), '/+$', '')"

# --- texts ---------------------------------------------------------------------------------

LINES = """
doc_lines AS (
  SELECT doc_id, lang, source, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents)),
words AS (
  SELECT *, string_split(line, ' ') AS ws, string_split(line, ' ')[1] AS w1,
    coalesce(string_split(line, ' ')[2], '') AS w2 FROM doc_lines)"""

_SNIP_SLUG = "lower(regexp_replace(w1 || '-' || w2, '[^A-Za-z-]', '', 'g'))"
_SEP = _pick("line_no", "' - '", "' – '", "' | '", "' • '")
_SHOWN = "CASE WHEN line_no % 5 = 4 THEN left(w2, 1) || '.' ELSE w2 END"
_LINK = _pick(
    "line_no",
    f"'https://www.linkedin.com/in/' || {_SNIP_SLUG} || '-' || lpad(lower(to_hex(doc_id)), 6, '0')",
    f"'https://linkedin.com/in/' || replace({_SNIP_SLUG}, '-', '') || '/'",
    "'https://team.' || source || lang || '.com/p/' || doc_id",
)
_LOCAL = _pick(
    "line_no",
    "lower(w1) || '.' || lower(w2)", "left(lower(w1), 1) || lower(w2)", "lower(w1) || '-' || lower(w2)",
    "lower(w1) || lower(w2)", "left(lower(w1), 1) || '.' || lower(w2)",
)
SNIPPETS = f"""{LINES},
snippets AS (
  SELECT doc_id, lang, source, line_no, line, {_LINK} AS url,
    CASE WHEN len(ws) >= 2 THEN w1 || ' ' || {_SHOWN} || {_SEP} || line || ' | LinkedIn' ELSE line END AS title,
    line || ' Contact: ' || {_LOCAL} || '@' || source || lang || '.com.' AS content,
    w1 || ' ' || w2 || CASE WHEN line_no % 7 = 3 THEN ', MBA' ELSE '' END AS full_name
  FROM words)"""

# headings to names: 'profiles' keeps the snippets that link a profile and give a name
PROFILES = rf"""
heads AS (
  SELECT *, {_trim(r"regexp_replace(title, '(?i)\s*[|–-]\s*linkedin\s*$', '')")} AS head
  FROM snippets WHERE url LIKE '%/in/%'),
read AS (
  SELECT *, {_trim(r"regexp_extract(head, '^(.+?)\s*[-–|•]\s*(.+)$', 1)")} AS nm,
    nullif({_trim(r"regexp_extract(head, '^(.+?)\s*[-–|•]\s*(.+)$', 2)")}, '') AS role,
    regexp_replace(regexp_extract(url, '/in/([^/]+)', 1), '(?i)-[a-f0-9]{{6,}}$', '') AS slug FROM heads),
hinted AS (
  SELECT *, list_filter(string_split_regex(nm, '\s+'), lambda x: x <> '') AS nws,
    coalesce(lower(list_filter(string_split_regex(nm, '\s+'), lambda x: x <> '')[1]), '') AS hint FROM read
  WHERE length(nm) BETWEEN 2 AND 60 AND NOT regexp_matches(nm, '\p{{Nd}}')),
spelled AS (
  SELECT *, CASE
      WHEN slug LIKE '%-%' THEN array_to_string(list_transform(
        list_filter(string_split(slug, '-'), lambda t: t <> ''), lambda t: upper(left(t, 1)) || substr(t, 2)), ' ')
      WHEN hint <> '' AND starts_with(slug, hint) THEN
        upper(left(hint, 1)) || substr(hint, 2) || CASE WHEN length(slug) > length(hint)
          THEN ' ' || upper(substr(slug, length(hint) + 1, 1)) || substr(slug, length(hint) + 2) ELSE '' END
      ELSE upper(left(slug, 1)) || substr(slug, 2) END AS by_slug FROM hinted),
profiles AS (
  SELECT * REPLACE (source AS source), CASE
      WHEN len(list_filter(nws, lambda w: length(w) = 1 OR regexp_matches(w, '^[A-Za-z]\.$'))) > 0 AND by_slug <> ''
      THEN by_slug ELSE nm END AS name FROM spelled)"""

_QUERY_IDX = "least(line_no // 3, 5)"
_BACKEND = _pick("doc_id + line_no", *[f"'{b}'" for b in K.BACKENDS])
_TERM = f"""CASE WHEN {_QUERY_IDX} < 2 THEN 'technical recruiter'
  WHEN {_QUERY_IDX} < 4 THEN 'engineering recruiter' ELSE 'talent' END"""
_SOURCE = "CASE backend WHEN 'ddg' THEN 'duckduckgo' ELSE backend END"

# hits need a profile host, save on the HTML backend where any /in/ link will do
HITS = f"""
hits AS (
  SELECT 'doc' || doc_id AS job_key, {_QUERY_IDX} AS query_idx, {_TERM} AS term, {_BACKEND} AS backend,
    line_no AS hit_rank, url, name, role, doc_id, regexp_replace(lower(url), '/+$', '') AS profile_key
  FROM profiles)"""

FETCHES = f"""
fetches AS (
  SELECT 'doc' || doc_id AS job_key, line_no, {_QUERY_IDX} AS query_idx, {_BACKEND} AS backend,
    [200, 200, 200, 200, 202, 429, 401, 402, 403, 400][length(line) % 10 + 1] AS http_status,
    {_pick("length(line) // 10", "line", "line || ' <b>Anomaly</b>'",
           "'{\"error\": {\"message\": \"quota ' || doc_id || '\"}}'")} AS body,
    (length(line) // 10) % 3 AS shape, doc_id FROM doc_lines),
outcomes AS (
  SELECT *, CASE
      WHEN backend = 'ddg' AND http_status = 202 THEN 'blocked'
      WHEN backend IN ('ddg', 'tavily') AND http_status = 429 THEN 'rate_limited'
      WHEN backend IN ('brave', 'google_cse') AND http_status = 429 THEN 'quota'
      WHEN backend = 'brave' AND http_status = 402 THEN 'quota'
      WHEN backend IN ('brave', 'tavily') AND http_status = 401 THEN 'bad_key'
      WHEN backend = 'google_cse' AND http_status = 403 THEN 'bad_key'
      WHEN http_status <> 200 THEN 'error'
      WHEN backend = 'ddg' AND (lower(body) LIKE '%anomaly%' OR body LIKE '%challenge-form%') THEN 'blocked'
      ELSE 'ok' END AS outcome,
    CASE WHEN backend = 'google_cse' AND http_status = 400
      THEN CASE WHEN shape = 2 THEN 'quota ' || doc_id ELSE 'Bad request' END END AS detail FROM fetches)"""


def _sticky() -> str:
    """The pointer of each query, one step after the other."""
    names = _list(K.BACKENDS)
    steps = [
        f"""oks AS (
  SELECT job_key, query_idx, list_position({names}, backend) - 1 AS slot FROM outcomes WHERE outcome = 'ok' GROUP BY ALL),
ends AS (SELECT job_key, max(query_idx) AS last_idx FROM outcomes GROUP BY job_key),
at0 AS (SELECT job_key, last_idx, 0 AS p FROM ends)"""
    ]
    for q in range(6):
        steps.append(
            f"""at{q + 1} AS (
  SELECT a.job_key, a.last_idx, coalesce(min(o.slot), 4) AS p
  FROM at{q} a LEFT JOIN oks o ON o.job_key = a.job_key AND o.query_idx = {q} AND o.slot >= a.p GROUP BY ALL)"""
        )
    rows = " UNION ALL ".join(
        f"SELECT job_key, {q} AS query_idx, {names}[p + 1] AS backend FROM at{q + 1} WHERE p < 4 AND {q} <= last_idx"
        for q in range(6)
    )
    return ",\n".join(steps) + f",\nsticky AS ({rows})"


STICKY = _sticky()

FOUND = f"""
used_hits AS (SELECT hits.* FROM hits JOIN sticky USING (job_key, query_idx, backend)),
seen AS (
  SELECT * FROM used_hits
  QUALIFY row_number() OVER (PARTITION BY job_key, profile_key ORDER BY query_idx, hit_rank) = 1),
counted AS (
  SELECT *, (SELECT count(*) FROM seen s WHERE s.job_key = seen.job_key AND s.query_idx < seen.query_idx) AS before
  FROM seen),
found AS (
  SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY query_idx, hit_rank) AS contact_rank,
    {_SOURCE} || ' [' || term || ']' AS tagged
  FROM counted WHERE before < {K.MAX_RESULTS} AND (term <> 'talent' OR before = 0)
  QUALIFY contact_rank <= {K.MAX_RESULTS})"""

# --- names and addresses ------------------------------------------------------------------------


def _letters(x: str) -> str:
    return f"regexp_replace(strip_accents(lower({x})), '[^a-z]', '', 'g')"


def _names(table: str, name: str, out: str) -> str:
    """first and last per row of a table."""
    cut = r",\s*[A-Z][\p{L}\p{N}_\-.]+(?:\s+[A-Z][\p{L}\p{N}_\-.]+)*$"
    return rf"""
{out}_words AS (
  SELECT *, list_filter(string_split_regex(regexp_replace({name}, '{cut}', ''), '\s+'), lambda w: w <> '') AS pw
  FROM {table}),
{out}_parts AS (
  SELECT *, {_letters("pw[1]")} AS p1,
    coalesce(nullif({_letters(r"list_filter(pw[2:], lambda w: length(regexp_replace(w, '\.+$', '')) > 1)[1]")}, ''),
             {_letters("pw[2]")}) AS p2 FROM {out}_words),
{out} AS (
  SELECT *, CASE WHEN len(pw) >= 2 AND p1 <> '' AND p2 <> '' THEN p1 END AS first,
    CASE WHEN len(pw) >= 2 AND p1 <> '' AND p2 <> '' THEN p2 END AS last FROM {out}_parts)"""


def _made(pattern: str, domain: str) -> str:
    """Candidate list for a pattern column (null: all six)."""
    one = {
        "{first}.{last}": "first || '.' || last",
        "{f}{last}": "left(first, 1) || last",
        "{first}{l}": "first || left(last, 1)",
        "{first}": "first",
        "{f}.{last}": "left(first, 1) || '.' || last",
        "{first}{last}": "first || last",
    }
    every = ", ".join(f"{e} || '@' || {domain}" for e in one.values())
    whens = " ".join(f"WHEN '{p}' THEN [{e} || '@' || {domain}]" for p, e in one.items())
    return f"CASE WHEN first IS NULL OR {domain} IS NULL THEN CAST([] AS VARCHAR[]) WHEN {pattern} IS NULL THEN [{every}] ELSE CASE {pattern} {whens} END END"


_MINE = r"(?i)(?:^|[^\p{L}\p{N}_])([a-z][a-z0-9]*(?:[.\-][a-z][a-z0-9]*)*)@([\p{L}\p{N}_.\-]+)"
MINED = f"""
fields AS (SELECT unnest([title, content, url]) AS t FROM snippets),
mined AS (
  SELECT lower(unnest(regexp_extract_all(t, '{_MINE}', 1))) AS local,
         lower(unnest(regexp_extract_all(t, '{_MINE}', 2))) AS host FROM fields),
wanted AS (SELECT DISTINCT source || lang || '.com' AS domain FROM documents),
pats AS (
  SELECT host, CASE
      WHEN length(local) - length(replace(local, '.', '')) > 1 THEN NULL
      WHEN local LIKE '%.%' AND strpos(local, '.') = 2 THEN '{{f}}.{{last}}'
      WHEN local LIKE '%.%' OR local LIKE '%-%' THEN '{{first}}.{{last}}'
      WHEN length(local) <= {K.SHORT_LOCAL_PART} THEN '{{f}}{{last}}' ELSE '{{first}}{{last}}' END AS pattern FROM mined),
per_host AS (SELECT host, pattern, count(*) AS n FROM pats WHERE pattern IS NOT NULL GROUP BY ALL),
pattern_votes AS (
  SELECT domain, pattern, sum(n)::BIGINT AS votes FROM per_host JOIN wanted
    ON starts_with(host, domain) AND NOT regexp_matches(substr(host, length(domain) + 1), '^[\\p{{L}}\\p{{N}}_]')
  GROUP BY ALL),
top_patterns AS (
  SELECT domain, pattern FROM pattern_votes
  QUALIFY row_number() OVER (PARTITION BY domain ORDER BY votes DESC, list_position({_list(K.ADDRESS_PATTERNS)}, pattern)) = 1)"""

ADDRESSED = f"""
site_votes AS (
  SELECT source AS company, source || lang || '.com' AS domain, count(*) AS votes, min(doc_id * 1000000 + line_no) AS r
  FROM doc_lines WHERE line_no % 3 = 2 GROUP BY ALL),
sites AS (
  SELECT company, domain FROM site_votes
  QUALIFY row_number() OVER (PARTITION BY company ORDER BY votes DESC, r, domain) = 1),
companies AS (SELECT company, domain, pattern FROM sites LEFT JOIN top_patterns USING (domain)),
{_names("profiles", "name", "named")},
addressed AS (
  SELECT n.doc_id, n.line_no, n.source AS company, n.name, c.domain, c.pattern, {_made("c.pattern", "c.domain")} AS candidates
  FROM named n LEFT JOIN companies c ON c.company = n.source)"""

# --- outreach -----------------------------------------------------------------------------------

_FAMILY_LIST = _list([f for f, _ in K.JOB_FAMILIES] + ["Unlisted"])
POSTINGS = f"""
postings AS (
  SELECT c_custkey, 'c' || c_custkey AS job_key, CASE WHEN c_custkey % 13 = 0 THEN '  ' ELSE ' ' || c_name END AS company,
    {_FAMILY_LIST}[c_custkey % 17 + 1] AS job_family,
    {_pick("c_nationkey", "n_name || ', FL, USA'", "'China, ' || n_name", "'New York, NY'", "r_name", "''", "NULL")} AS location,
    c_mktsegment, c_name, r_name,
    'Exploring the ' || c_mktsegment || ' role at ' || c_name AS email_subject,
    CASE WHEN c_custkey % 10 = 0 THEN ''
      ELSE 'Hi there,' || chr(10) || chr(10) || 'About ' || c_name || '. Hi there,' || chr(10) || chr(10) || 'Best,' || chr(10)
      END AS email_body
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

CONTACTS = f"""{POSTINGS},
raw_contacts AS (
  SELECT job_key, o_orderkey AS contact_rank, CASE WHEN o_orderkey % 11 = 0 THEN c_mktsegment
      ELSE c_mktsegment || ' ' || r_name || CASE WHEN o_orderkey % 7 = 0 THEN ', MBA' ELSE '' END END AS name,
    CASE WHEN o_orderkey % 3 = 0 THEN '{{first}}.{{last}}' END AS pattern, job_key || '.example.com' AS domain,
    o_orderstatus AS st, o_orderdate, CAST(left(o_orderpriority, 1) AS INT) AS tries
  FROM orders JOIN postings ON o_custkey = c_custkey),
{_names("raw_contacts", "name", "parsed")},
addressed_contacts AS (SELECT *, {_made("pattern", "domain")} AS candidates FROM parsed),
contacts AS (
  SELECT *, CASE WHEN st <> 'O' THEN candidates[1:tries] ELSE CAST([] AS VARCHAR[]) END AS tried,
    CASE WHEN st <> 'O' THEN o_orderdate END AS sent_at,
    CASE WHEN st <> 'O' THEN candidates[1:tries][-1] END AS sent_to,
    CASE WHEN st = 'F' THEN contact_rank % 2 = 0 END AS bounced FROM addressed_contacts),
states AS (
  SELECT *, list_filter(candidates, lambda c: NOT list_contains(tried, c)) AS untried FROM contacts),
ready AS (
  SELECT *, len(untried) > 0 AND (sent_at IS NULL OR coalesce(bounced, false)) AS eligible FROM states),
plan AS (
  SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY contact_rank) AS send_no FROM ready WHERE eligible
  QUALIFY send_no <= {K.MAX_SEND}),
after_send AS (
  SELECT r.job_key, r.contact_rank, r.name, r.candidates,
    CASE WHEN p.send_no IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE r.sent_at END AS sent_at,
    CASE WHEN p.send_no IS NOT NULL THEN r.untried[1] ELSE r.sent_to END AS sent_to,
    CASE WHEN p.send_no IS NOT NULL THEN list_append(r.tried, r.untried[1]) ELSE r.tried END AS tried,
    CASE WHEN p.send_no IS NULL THEN r.bounced END AS bounced
  FROM ready r LEFT JOIN plan p ON p.job_key = r.job_key AND p.contact_rank = r.contact_rank)"""

# --- notices --------------------------------------------------------------------------------------

NOTICES = """
notices AS (
  SELECT event_id AS message_id, ts AS received_at, CASE WHEN event_id % 5 = 3 THEN NULL
      ELSE 'u' || user_id || '@example.com' END AS address
  FROM events WHERE event_id % 4 <> 2 AND event_id % 5 <> 3)"""
_SINCE = "(SELECT max(ts) FROM events) - INTERVAL 10080 MINUTE"
RECONCILED = f"""{NOTICES},
gone AS (SELECT DISTINCT address FROM notices WHERE received_at >= {_SINCE}),
polled AS (
  SELECT event_id, event_type, 'U' || user_id || '@example.com' AS sent_to, 'u' || user_id || '@example.com' AS low,
    CAST(json_extract_string(props, '$.k') AS INT) AS k, ts FROM events),
was AS (
  SELECT *, CASE WHEN k % 10 <> 0 THEN ts END AS sent_at, CASE k % 3 WHEN 1 THEN true WHEN 2 THEN false END AS bounced FROM polled),
reconciled AS (
  SELECT event_type AS job_key, event_id AS contact_rank, sent_to, CASE
      WHEN sent_at < {_SINCE} THEN bounced
      WHEN low IN (SELECT address FROM gone) THEN true ELSE coalesce(bounced, false) END AS bounced FROM was)"""

# --- page text: tags of the given pages are closed, so patterns can strip them -------------------------

_BARE = "html"
for _tag in ("script", "style", "nav", "footer"):
    _BARE = f"regexp_replace({_BARE}, '(?s)<{_tag}>.*?</{_tag}>', chr(10), 'g')"
_BARE = f"regexp_replace(regexp_replace({_BARE}, '(?s)<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g')"


def _decoded(x: str) -> str:
    """The references the given pages hold; cut-off titles leave some without ';', which HTML reads alike."""
    return f"regexp_replace(regexp_replace({x}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


PAGE_TEXT = f"""
page_lines AS (
  SELECT page_id, url, {_trim("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS raw_title,
    array_to_string(list_filter(list_transform(string_split({_decoded(_BARE)}, chr(10)), lambda l: {_trim("l")}),
      lambda l: l <> ''), chr(10)) AS whole FROM pages),
page_text AS (
  SELECT page_id, url, left(whole, {K.MAX_TEXT}) AS raw_text, whole <> '' AS success,
    {_decoded("raw_title")} AS page_title FROM page_lines)"""


def _text_of(lines: str) -> str:
    """Trimmed non-blank lines of a list."""
    return f"array_to_string(list_filter(list_transform({lines}, lambda l: {_trim('l')}), lambda l: l <> ''), chr(10))"


_FIRST_WORD = r"string_split_regex(text, '[ \n]')[1]"
_DOC_TITLE = r"string_split_regex(text, '[.\n]')[1]"

ORACLES: dict[str, str] = {
    "canonical_urls": _with(VARIANTS, CANONICAL) + "SELECT page_id, variant, url, canonical_url FROM canon",
    "platform_labels": _with(VARIANTS, CANONICAL)
    + rf"""SELECT page_id, variant, {PLATFORM} AS platform,
  nullif(regexp_extract(canonical_url, 'greenhouse\.io/([^/]+)/jobs/\d+', 1), '') AS ats_company,
  nullif(regexp_extract(canonical_url, 'greenhouse\.io/[^/]+/jobs/(\d+)', 1), '') AS ats_job_id FROM canon""",
    "root_domain_votes": _with(VARIANTS, VOTES) + "SELECT * FROM votes",
    "top_domains": _with(VARIANTS, VOTES)
    + """SELECT * FROM votes
QUALIFY row_number() OVER (PARTITION BY company ORDER BY votes DESC, first_rank, domain) = 1""",
    "company_domains": """
WITH t AS (
  SELECT c_name AS company,
    nullif(CASE WHEN c_custkey % 2 = 0 THEN [lower(c_mktsegment) || '.com', '', lower(c_mktsegment) || '.com'][c_custkey % 3 + 1] END, '') AS a,
    nullif(CASE WHEN c_custkey % 3 = 0 THEN ['', 'second.com'][c_custkey % 2 + 1] END, '') AS b,
    CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 = 0 THEN 'third.com' END AS c FROM customer)
SELECT company, coalesce(a, b, c) AS domain,
  CASE WHEN a IS NOT NULL THEN 1 WHEN b IS NOT NULL THEN 2 WHEN c IS NOT NULL THEN 3 END AS tier FROM t""",
    "deduped_pages": _with(VARIANTS, CANONICAL)
    + f"""SELECT {_KEY} AS url_key, page_id, variant FROM canon
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY page_id, variant) = 1""",
    "unseen_pages": _with(VARIANTS, CANONICAL)
    + f"""SELECT {_KEY} AS url_key, page_id, variant FROM canon
WHERE url LIKE 'https:%' AND {_KEY} NOT IN (SELECT {_KEY} FROM canon WHERE url LIKE 'http:%')
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY page_id, variant) = 1""",
    "page_texts": _with(VARIANTS, CANONICAL, PAGE_TEXT)
    + """SELECT t.page_id, c.canonical_url, 'generic' AS platform, page_title, raw_text, success,
  CASE WHEN NOT success THEN 'no text extracted' END AS error
FROM page_text t JOIN canon c ON c.page_id = t.page_id AND c.variant = 0""",
    "page_previews": _with(PAGE_TEXT)
    + f"SELECT page_id, replace(left(raw_text, {K.PREVIEW_CHARS}), chr(10), ' ↵ ') AS preview FROM page_text",
    "text_sizes": _with(PAGE_TEXT)
    + """SELECT 'generic' AS platform, count(*) AS postings, sum(length(raw_text))::BIGINT AS chars,
  max(length(raw_text)) AS longest FROM page_text""",
    "page_links": r"""
WITH a AS (
  SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts FROM pages)
SELECT page_id, unnest(generate_series(0, len(hs) - 1)) AS link_pos,
  replace(replace(unnest(hs), '&quot;', '"'), '&amp;', '&') AS href,
  trim(replace(replace(unnest(ts), '&quot;', '"'), '&amp;', '&')) AS link_text FROM a WHERE len(hs) > 0""",
    "lever_postings": f"""
WITH d AS (SELECT *, string_split(text, chr(10)) AS ls, {_FIRST_WORD} AS w FROM documents),
b AS (
  SELECT *, 'Opening ' || doc_id AS page_title, doc_id % 5 = 0 AS broken,
    CASE WHEN doc_id % 3 = 0 THEN {_text_of("flatten([['Opening ' || doc_id], flatten(list_transform(ls, lambda l: ['Part', l]))])")}
      ELSE array_to_string(list_transform(CASE WHEN len(ls) > 1 THEN ls[:len(ls) - 1] ELSE ls END,
        lambda l: {_trim("'Part' || chr(10) || l")}), chr(10) || chr(10)) END AS body FROM d),
f AS (
  SELECT *, CASE WHEN broken THEN '' ELSE w END AS ld_title, CASE WHEN broken THEN '' ELSE source END AS ld_company,
    CASE WHEN broken THEN '' ELSE lang END AS ld_location FROM b)
SELECT doc_id, 'lever' AS platform, page_title, ld_title, ld_company, ld_location, true AS success,
  left('Job Title: ' || CASE WHEN ld_title = '' THEN page_title ELSE ld_title END || chr(10) || 'Company: ' || ld_company
    || chr(10) || 'Location: ' || ld_location || chr(10) || chr(10) || body, {K.MAX_TEXT}) AS raw_text FROM f""",
    "ats_postings": f"""
WITH d AS (
  SELECT *, {_FIRST_WORD} AS title, {_pick("doc_id", "lang || ', ' || source", "source", "''")} AS location,
    {_text_of("string_split(text, chr(10))")} AS body FROM documents)
SELECT doc_id, source AS ats_company, CAST(doc_id AS VARCHAR) AS ats_job_id, title, location, title || ' at ' || source AS page_title,
  left('Job Title: ' || title || chr(10) || 'Company: ' || source || chr(10) || 'Location: ' || location || chr(10) || chr(10) || body,
    {K.MAX_TEXT}) AS raw_text FROM d""",
    "posting_keys": f"""
WITH d AS (
  SELECT doc_id, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents)
SELECT doc_id, {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key,
  'Exploring the ' || title || ' role at ' || company AS email_subject FROM d""",
    "model_responses": f"""
WITH a AS (
  SELECT *, p_partkey % 10 AS shape, ['Software Engineering', 'Data Science', 'AI / ML', 'Head of legal affairs ', 'xx',
    'Policy / Government Affairs', 'devops /', 'Marketing manager'][p_size % 8 + 1] AS fam FROM part),
m AS (
  SELECT *, CASE fam WHEN 'Software Engineering' THEN fam WHEN 'Policy / Government Affairs' THEN fam
    WHEN 'AI / ML' THEN 'Data Science / ML' WHEN 'devops /' THEN 'DevOps / Infrastructure'
    WHEN 'Head of legal affairs ' THEN 'Legal / Compliance' WHEN 'Marketing manager' THEN 'Marketing' ELSE 'Other' END AS family,
    CASE shape WHEN 2 THEN 'not json' WHEN 3 THEN 'field is not text' WHEN 7 THEN 'not an object'
      WHEN 8 THEN 'field is not text' WHEN 9 THEN 'location is not text' END AS problem FROM a)
SELECT p_partkey, problem,
  CASE WHEN problem IS NULL THEN CASE WHEN shape = 6 THEN p_type ELSE p_name END END AS job_title,
  CASE WHEN problem IS NULL THEN p_brand END AS company,
  CASE WHEN problem IS NULL THEN CASE WHEN shape = 4 THEN 'Other' ELSE family END END AS job_family,
  CASE WHEN problem IS NULL AND shape NOT IN (5, 6) THEN p_type || ', USA' END AS location,
  problem IS NOT NULL AS company_doubtful, problem IS NOT NULL AS title_blank FROM m""",
    "analysis_prompts": _with(PAGE_TEXT)
    + f"SELECT page_id, {_text(T.ANALYSIS_ASK)} || left(raw_text, {K.ANALYSIS_CHARS}) AS prompt FROM page_text",
    "draft_prompts": f"""
WITH r AS (SELECT text AS resume FROM documents ORDER BY length(text) DESC, doc_id LIMIT 1)
SELECT doc_id, 'Name: there' || chr(10) || 'Company: ' || source || ' & ' || lang || chr(10) || 'Role: ' || {_DOC_TITLE}
  || chr(10) || 'URL: https://jobs.example.com/' || doc_id || chr(10) || chr(10) || 'Posting:' || chr(10)
  || left(text, {K.DRAFT_POSTING_CHARS}) || chr(10) || chr(10) || 'Resume:' || chr(10)
  || left(resume, {K.DRAFT_RESUME_CHARS}) || {_text(T.DRAFT_ASK)} AS prompt FROM documents, r""",
    "stored_files": f"""
WITH d AS (
  SELECT *, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents),
k AS (SELECT {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key FROM d)
SELECT DISTINCT CAST('0x' || left(md5(job_key), 4) AS INT) % 64 AS folder FROM k""",
    "posting_documents": f"""
WITH d AS (
  SELECT *, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents)
SELECT {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key,
  'https://jobs.example.com/' || doc_id AS url, 'generic' AS platform, title AS job_title, company,
  CAST(NULL AS VARCHAR) AS location, text AS description FROM d""",
    "versioned_postings": f"""
WITH d AS (
  SELECT *, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents)
SELECT {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key,
  'https://jobs.example.com/' || doc_id AS url, company, CASE WHEN doc_id % 4 = 2 THEN 'old' ELSE text END AS description,
  CAST(CASE WHEN doc_id % 2 = 0 THEN 3 ELSE length(text) END AS INTEGER) AS n_before FROM d""",
    "listed_files": f"""
WITH d AS (
  SELECT *, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents)
SELECT {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key,
  true AS listed, true AS same_time, true AS same_size, true AS in_order
FROM d WHERE doc_id % 2 = 0 OR length(company) % 2 = 0""",
    "foreign_keys": f"""
WITH d AS (
  SELECT *, source || ' & ' || lang AS company, {_DOC_TITLE} AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS t FROM documents)
SELECT {_slug("company")} || '__' || {_slug("title")} || '__' || strftime(t, '%Y%m%d_%H%M%S') AS job_key,
  CASE WHEN doc_id % 3 = 0 THEN 'New subject' END AS email_subject,
  CAST(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_contacts,
  CASE WHEN doc_id % 4 = 0 THEN 'ann@example.com' WHEN doc_id % 2 = 0 THEN '' END AS tried,
  lang, source AS origin, CAST(n_chars AS BIGINT) AS n_chars FROM d""",
    "text_documents": f"SELECT CAST(item_id AS BIGINT) AS item_id, {_trim('text')} AS text FROM benchmark",
    "saved_drafts": _with(POSTINGS)
    + """, d AS (SELECT job_key, company,
    CASE WHEN c_custkey % 3 = 0 THEN 'New subject' ELSE email_subject END AS email_subject,
    CASE WHEN c_custkey % 3 = 0 THEN 'New body for ' || job_key ELSE email_body END AS email_body FROM postings)
SELECT *, email_subject <> '' AND email_body <> '' AS has_draft FROM d""",
    "query_cascade": _with(
        POSTINGS,
        "fams AS (SELECT unnest("
        + _list([f for f, _ in K.JOB_FAMILIES])
        + ") AS job_family, unnest(["
        + ", ".join(_list(t) for _, t in K.JOB_FAMILIES)
        + "]) AS terms)",
        rf"""asked AS (
  SELECT job_key, trim(company) AS company, coalesce(terms, {_list(K.DEFAULT_TERMS)}) AS terms,
    list_transform(string_split(location, ','), lambda p: trim(p)) AS ps FROM postings LEFT JOIN fams USING (job_family)
  WHERE trim(company) <> ''),
placed AS (
  SELECT *, nullif(coalesce(list_filter(ps, lambda p: lower(p) NOT IN {_in(K.STATES_AND_COUNTRIES)} AND length(p) > 1)[1], ps[1]), '') AS city
  FROM asked),
termed AS (SELECT *, unnest([terms[1], terms[2], 'talent']) AS term, unnest([0, 1, 2]) AS t FROM placed),
both_ways AS (
  SELECT job_key, term, t, 0 AS w, 'site:linkedin.com/in "' || company || '" "' || term || '" "' || city || '"' AS query FROM termed WHERE city IS NOT NULL
  UNION ALL SELECT job_key, term, t, 1, 'site:linkedin.com/in "' || company || '" "' || term || '"' FROM termed)""",
    )
    + "SELECT job_key, row_number() OVER (PARTITION BY job_key ORDER BY t, w) - 1 AS query_idx, query, term FROM both_ways",
    "unsearchable_postings": _with(POSTINGS) + "SELECT job_key, job_family FROM postings WHERE trim(company) = ''",
    "search_payload_hits": _with(SNIPPETS)
    + f"""SELECT 'doc' || doc_id AS job_key, {_pick("doc_id", "'brave'", "'tavily'", "'google_cse'")} AS backend, line_no AS hit_rank,
  url, title, CASE WHEN doc_id % 3 = 1 THEN content ELSE '' END AS content FROM snippets""",
    "result_page_contacts": _with(SNIPPETS, PROFILES)
    + "SELECT doc_id, line_no AS hit_rank, url, name, role, 'duckduckgo' AS source FROM profiles",
    "profile_contacts": _with(SNIPPETS, PROFILES)
    + f"""SELECT 'doc' || doc_id AS job_key, line_no AS hit_rank, url, name, role,
  {_pick("doc_id", "'brave'", "'tavily'", "'google_cse'")} AS source FROM profiles
UNION ALL SELECT 'doc' || doc_id, line_no, url, name, role, 'duckduckgo' FROM profiles""",
    "fetch_outcomes": _with(LINES, FETCHES)
    + "SELECT job_key, line_no, query_idx, backend, http_status, outcome, detail FROM outcomes",
    "sticky_backends": _with(LINES, FETCHES, STICKY) + "SELECT * FROM sticky",
    "unplanned_requests": _with(LINES, FETCHES)
    + "SELECT job_key, line_no, CAST(line_no // 3 AS INTEGER) AS query_idx, outcome FROM outcomes WHERE line_no // 3 > 5",
    "first_seen_profiles": _with(SNIPPETS, PROFILES, HITS)
    + """SELECT job_key, profile_key, query_idx, hit_rank, name FROM hits
QUALIFY row_number() OVER (PARTITION BY job_key, profile_key ORDER BY query_idx, hit_rank) = 1""",
    "found_contacts": _with(SNIPPETS, PROFILES, HITS, FETCHES, STICKY, FOUND)
    + "SELECT job_key, contact_rank, name, role, url, tagged AS source FROM found",
    "query_yields": _with(SNIPPETS, PROFILES, HITS, FETCHES, STICKY, FOUND)
    + f""", n AS (
  SELECT *, row_number() OVER (PARTITION BY job_key, profile_key ORDER BY query_idx, hit_rank) = 1 AS fresh FROM used_hits),
q AS (SELECT job_key, query_idx, term, count(*) AS hits, count(*) FILTER (fresh) AS new_hits FROM n GROUP BY ALL),
w AS (SELECT *, coalesce(sum(new_hits) OVER (PARTITION BY job_key ORDER BY query_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT job_key, query_idx, term, hits, new_hits FROM w WHERE before < {K.MAX_RESULTS} AND (term <> 'talent' OR before = 0)""",
    "mined_addresses": _with(SNIPPETS, MINED) + "SELECT local, host, count(*) AS found FROM mined GROUP BY ALL",
    "mined_document_addresses": r"""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?i)(?:^|[^\p{L}\p{N}_])([a-z][a-z0-9.\-]*)@([\p{L}\p{N}_.\-]+)', 1) AS l,
  regexp_extract_all(text, '(?i)(?:^|[^\p{L}\p{N}_])([a-z][a-z0-9.\-]*)@([\p{L}\p{N}_.\-]+)', 2) AS h FROM documents)
SELECT doc_id, lower(unnest(l)) AS local, lower(unnest(h)) AS host FROM m""",
    "pattern_votes": _with(SNIPPETS, MINED) + "SELECT * FROM pattern_votes",
    "domain_patterns": _with(
        SNIPPETS,
        MINED,
        """chosen AS (
  SELECT w.domain, coalesce(CASE WHEN length(w.domain) % 2 = 0 THEN t.pattern END,
    CASE WHEN ascii(substr(w.domain, 5, 1)) % 3 = 0 THEN '{first}' END) AS pattern
  FROM wanted w LEFT JOIN top_patterns t USING (domain))""",
    )
    + f"""SELECT domain, pattern, array_to_string({_made("pattern", "domain")}, ',') AS sample
FROM (SELECT *, 'jane' AS first, 'doe' AS last FROM chosen)""",
    "name_parts": _with(SNIPPETS, _names("snippets", "full_name", "named"))
    + "SELECT doc_id, line_no, first, last FROM named",
    "name_candidates": _with(
        SNIPPETS,
        _names("snippets", "full_name", "named"),
        f"""formed AS (SELECT *, 'acme.com' AS domain, {_pick("line_no", "'{f}.{last}'", "NULL", "'{first}{l}'")} AS pattern FROM named)""",
    )
    + f"""SELECT doc_id, line_no, array_to_string({_made("pattern", "domain")}, ',') AS email FROM formed""",
    "contact_addresses": _with(SNIPPETS, PROFILES, MINED, ADDRESSED)
    + "SELECT doc_id, line_no, company, domain, pattern, array_to_string(candidates, ',') AS email FROM addressed",
    "primary_addresses": _with(SNIPPETS, PROFILES, MINED, ADDRESSED)
    + "SELECT doc_id, line_no, name, candidates[1] AS primary_address FROM addressed WHERE len(candidates) > 0",
    "address_coverage": _with(SNIPPETS, PROFILES, MINED, ADDRESSED)
    + """SELECT company, count(*) AS contacts, count(*) FILTER (len(candidates) > 0) AS with_address
FROM addressed GROUP BY company""",
    "capped_contacts": f"""SELECT o_custkey, o_orderkey, o_orderdate,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS contact_rank
FROM orders QUALIFY contact_rank <= {K.MAX_RESULTS}""",
    "outbox": _with(CONTACTS)
    + """SELECT p.job_key, contact_rank, send_no, name, untried[1] AS to_address, email_subject AS subject,
  CASE WHEN first IS NULL THEN 'Hi there,' ELSE 'Hi ' || upper(left(first, 1)) || substr(first, 2) || ',' END
    || chr(10) || chr(10) || 'About ' || c_name || '. Hi there,' || chr(10) || chr(10) || 'Best,' || chr(10) || 'Sam Sender' || chr(10) AS body,
  'Sam Sender' AS from_name, len(tried) + 1 AS attempt,
  CASE WHEN len(tried) > 0 THEN '[retry ' || (len(tried) + 1) || '/' || len(candidates) || ']' ELSE '' END AS attempt_label
FROM plan p JOIN postings USING (job_key) WHERE email_body <> '' AND email_subject <> ''""",
    "undrafted_postings": _with(POSTINGS) + "SELECT job_key, email_subject FROM postings WHERE email_body = ''",
    "outreach_summary": _with(CONTACTS)
    + """SELECT job_key, count(*) AS total, count(*) FILTER (len(candidates) > 0) AS with_email,
  count(*) FILTER (sent_at IS NOT NULL) AS already_sent, count(*) FILTER (bounced) AS bounced,
  count(*) FILTER (eligible) AS eligible, count(*) FILTER (sent_at IS NOT NULL AND bounced IS NULL) AS pending
FROM ready GROUP BY job_key""",
    "numbered_contacts": _with(CONTACTS)
    + """SELECT job_key, contact_rank, row_number() OVER (PARTITION BY job_key ORDER BY contact_rank) AS shown_no
FROM contacts""",
    "delivery_labels": _with(CONTACTS)
    + """SELECT job_key, contact_rank, sent_to AS email_sent_to,
  CASE WHEN bounced IS NULL THEN 'pending' WHEN bounced THEN 'bounced' ELSE 'delivered' END AS delivery
FROM ready WHERE sent_to <> ''""",
    "next_patterns": _with(CONTACTS)
    + "SELECT job_key, contact_rank, coalesce(untried[1], 'exhausted') AS next_step FROM ready WHERE bounced",
    "send_states": _with(CONTACTS)
    + """SELECT job_key, contact_rank, sent_at AS email_sent_at, sent_to AS email_sent_to,
  array_to_string(tried, ',') AS tried, CAST(bounced AS VARCHAR) AS email_bounced FROM after_send""",
    "replaced_contacts": _with(CONTACTS)
    + """SELECT r.job_key, r.contact_rank, array_to_string(
  CASE WHEN CAST(substr(r.job_key, 2) AS BIGINT) % 2 = 0 THEN a.tried ELSE r.tried END, ',') AS tried
FROM ready r JOIN after_send a USING (job_key, contact_rank)""",
    "contact_documents": _with(CONTACTS)
    + """SELECT r.job_key, row_number() OVER (PARTITION BY r.job_key ORDER BY r.contact_rank) AS contact_rank, r.name,
  array_to_string(r.candidates, ',') AS email, 'brave' AS source, array_to_string(
  CASE WHEN CAST(substr(r.job_key, 2) AS BIGINT) % 2 = 0 THEN a.tried ELSE r.tried END, ',') AS tried
FROM ready r JOIN after_send a USING (job_key, contact_rank)""",
    "bounce_recipients": _with(NOTICES) + "SELECT message_id, received_at, address FROM notices",
    "stored_notices": _with(NOTICES) + "SELECT message_id, address FROM notices",
    "streamed_notices": _with(NOTICES) + "SELECT message_id, address FROM notices WHERE message_id % 97 <> 0",
    "notice_quarantine": "SELECT '{broken ' || event_id AS record FROM events WHERE event_id % 97 = 0",
    "bounced_addresses": _with(NOTICES)
    + f"SELECT address, count(*) AS notices FROM notices WHERE received_at >= {_SINCE} GROUP BY address",
    "newest_notices": _with(NOTICES)
    + f"""SELECT message_id, received_at, address FROM notices
QUALIFY row_number() OVER (ORDER BY received_at DESC, message_id) <= {K.NOTICE_PAGE}""",
    "bounce_reconcile": _with(RECONCILED)
    + """SELECT job_key, contact_rank, sent_to AS email_sent_to, coalesce(CAST(bounced AS VARCHAR), 'open') AS state
FROM reconciled""",
    "bounce_totals": _with(RECONCILED)
    + "SELECT job_key, count(*) FILTER (bounced) AS bounced, count(*) AS contacts FROM reconciled GROUP BY job_key",
    "stream_outcomes": """
WITH s AS (
  SELECT event_id AS send_id, 'u' || user_id AS address, ts, user_id,
    to_timestamp((epoch(ts)::BIGINT // 21600) * 21600 + 43200)::TIMESTAMP AS ends FROM events WHERE event_type = 'signup'),
b AS (SELECT ts, user_id FROM events WHERE event_type = 'error'),
mark AS (SELECT least((SELECT max(ts) FROM s), (SELECT max(ts) FROM b)) - INTERVAL 1 HOUR AS watermark)
SELECT send_id, address, CASE WHEN ends > (SELECT watermark FROM mark) THEN 'pending'
  WHEN EXISTS (SELECT 1 FROM b WHERE b.user_id = s.user_id AND b.ts BETWEEN s.ts AND s.ts + INTERVAL 6 HOUR)
  THEN 'bounced' ELSE 'delivered' END AS outcome
FROM s""",
    "retry_events": """
WITH e AS (SELECT user_id AS contact_key, CAST(json_extract_string(props, '$.k') AS INT) % 6 + 1 AS attempt, event_type, ts
  FROM events WHERE event_type IN ('signup', 'error')),
a AS (SELECT contact_key, attempt, min(ts) FILTER (event_type = 'signup') AS sent, min(ts) FILTER (event_type = 'error') AS bounce FROM e GROUP BY ALL),
s AS (SELECT *, coalesce(bounce <= sent + INTERVAL 6 HOUR, false) AS bounced FROM a WHERE sent IS NOT NULL)
SELECT contact_key, attempt, 'pending' AS state, sent AS at FROM s
UNION ALL SELECT contact_key, attempt, 'bounced', bounce FROM s WHERE bounced
UNION ALL SELECT contact_key, attempt, CASE WHEN attempt < 6 THEN 'retry' ELSE 'exhausted' END, bounce FROM s WHERE bounced
UNION ALL SELECT contact_key, attempt, 'delivered', sent + INTERVAL 6 HOUR FROM s
  WHERE NOT bounced AND sent + INTERVAL 6 HOUR <= (SELECT max(ts) FROM e) - INTERVAL 1 HOUR""",
    "retry_states": """
WITH e AS (SELECT user_id AS contact_key, CAST(json_extract_string(props, '$.k') AS INT) % 6 + 1 AS attempt, event_type, ts FROM events),
a AS (
  SELECT contact_key, attempt, min(ts) FILTER (event_type = 'signup') AS sent_at, bool_or(event_type = 'error') AS bounced
  FROM e WHERE event_type IN ('signup', 'error') GROUP BY ALL),
c AS (
  SELECT contact_key, count(*) AS tried, count(*) FILTER (bounced) AS bounces,
    bool_or(NOT bounced AND sent_at + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events)) AS done,
    bool_or(NOT bounced AND sent_at + INTERVAL 6 HOUR > (SELECT max(ts) FROM events)) AS open
  FROM a WHERE sent_at IS NOT NULL GROUP BY contact_key)
SELECT contact_key, tried, bounces, CASE WHEN done THEN 'delivered' WHEN open THEN 'pending'
  WHEN tried < 6 THEN 'retry' ELSE 'exhausted' END AS state FROM c""",
    "ingested_postings": _with(VARIANTS, CANONICAL)
    + f"""SELECT page_id, canonical_url, {_KEY} AS url_key FROM canon WHERE variant = 0
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY page_id) = 1""",
    "stored_sends": """
SELECT user_id AS contact_key, CAST(json_extract_string(props, '$.k') AS INT) % 6 + 1 AS attempt, min(event_id) AS send_id
FROM events WHERE event_type = 'signup' GROUP BY ALL""",
    "contact_run": _with(SNIPPETS, PROFILES, HITS, FETCHES, STICKY, FOUND, MINED, ADDRESSED)
    + """SELECT f.job_key, f.contact_rank, f.name, f.tagged AS source, array_to_string(a.candidates, ',') AS email
FROM found f JOIN addressed a ON 'doc' || a.doc_id = f.job_key AND a.line_no = f.hit_rank""",
}


_RUN = _with(VARIANTS, CANONICAL, PAGE_TEXT) + f""",
addresses AS (
  SELECT canonical_url, 'generic' AS platform, page_title, raw_text, success, 'no text extracted' AS failure, t.page_id AS no
  FROM page_text t JOIN canon c ON c.page_id = t.page_id AND c.variant = 0
  UNION ALL
  SELECT 'https://jobs.lever.co/' || source || '/' || doc_id, 'lever', page_title, raw_text, true, NULL, doc_id
  FROM ({ORACLES["lever_postings"]}) JOIN documents USING (doc_id)
  UNION ALL
  SELECT 'https://boards.greenhouse.io/' || ats_company || '/jobs/' || doc_id, 'greenhouse', page_title, raw_text,
    doc_id % 7 <> 0, 'unreadable answer', doc_id FROM ({ORACLES["ats_postings"]})),
texts AS (
  SELECT * FROM addresses
  QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY success DESC, raw_text, page_title) = 1),
replies AS (
  SELECT canonical_url, no % 6 AS shape, 'Role ' || no AS title, 'Acme ' || no AS company FROM addresses WHERE no % 6 <> 0
  QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY CASE no % 6
    WHEN 1 THEN '{{"job_title": "Role ' || no WHEN 4 THEN '{{"job_title": "Role ' || no WHEN 2 THEN '{{"company": "Old'
    WHEN 3 THEN '{{oops' ELSE '{{"location"' END) = 1),
checked AS (
  SELECT t.*, CASE WHEN NOT success THEN failure WHEN shape IS NULL THEN 'no answer' WHEN shape = 3 THEN 'not json' END AS problem,
    CASE WHEN shape = 5 THEN page_title ELSE title END AS job_title,
    CASE WHEN shape = 5 THEN '' ELSE company END AS firm, shape
  FROM texts t LEFT JOIN replies r ON r.canonical_url = t.canonical_url)
"""

ORACLES["posting_run"] = _RUN + f"""SELECT
  {_slug("firm")} || '__' || {_slug("job_title")} || '__20240101_000000' AS job_key, canonical_url AS url, platform, job_title,
  firm AS company, CASE WHEN shape = 5 THEN 'Other' ELSE 'Marketing' END AS job_family,
  CASE WHEN shape = 5 THEN 'Rome' END AS location, raw_text AS description, shape = 5 AS company_doubtful,
  job_title = '' AS title_blank FROM checked WHERE problem IS NULL"""
ORACLES["posting_quarantine"] = _RUN + "SELECT canonical_url, problem FROM checked WHERE problem IS NOT NULL"

ORACLES["send_run"] = _with(RECONCILED) + f""", ready AS (
  SELECT 'U' || substr(split_part(low, '@', 1), 2) AS job_key, event_id AS contact_rank, low, w.sent_at IS NOT NULL AS sent
  FROM was w JOIN reconciled r ON r.contact_rank = w.event_id WHERE w.sent_at IS NULL OR r.bounced),
plan AS (
  SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY contact_rank) AS send_no FROM ready
  QUALIFY send_no <= {K.MAX_SEND})
SELECT job_key, contact_rank, send_no, CASE WHEN sent THEN 'second.' || low ELSE low END AS to_address,
  'Role for ' || job_key AS subject, 'Hi Jane,' || chr(10) || chr(10) || 'Best,' || chr(10) AS body,
  CASE WHEN sent THEN 2 ELSE 1 END AS attempt, CASE WHEN sent THEN '[retry 2/2]' ELSE '' END AS attempt_label FROM plan"""
