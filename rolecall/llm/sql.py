"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_source_mix"] = r"""
WITH docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey
  FROM documents
), sizes AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS w
  FROM docs GROUP BY skey
), ranked AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER o, 0) AS spent, coalesce(sum(w) OVER o, 0) AS used
  FROM sizes
  WINDOW o AS (ORDER BY 3 * source_size / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT *, cap * (weights - used) <= (total - spent) * w AS is_cut FROM ranked
), targets AS (
  SELECT skey, source_size, CASE WHEN is_cut THEN CAST(cap AS DOUBLE) ELSE
    CAST((total - coalesce(sum(CASE WHEN is_cut THEN cap END) OVER (), 0)) * w AS DOUBLE)
      / CAST(sum(CASE WHEN NOT is_cut THEN w END) OVER () AS DOUBLE) END AS target
  FROM cut
), quotas AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM targets
), placed AS (
  SELECT d.*, q.source_size, q.target, q.quota,
    coalesce(sum(d.size) OVER (PARTITION BY d.skey ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ' ' || d.size),
      d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at
  FROM docs d JOIN quotas q USING (skey)
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE
  (quota // source_size) * size + greatest(0, least(begin_at + size, quota % source_size) - begin_at) END AS BIGINT) AS taken
FROM placed
"""

ORACLES["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
    regexp_replace(unnest(string_split(text, chr(10))), '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g') AS line
  FROM documents
), full_lines AS (
  SELECT * FROM lines WHERE length(line) >= 1
), starts AS (
  SELECT line, min(struct_pack(d := doc_id, n := line_no)) AS first, length(line) AS size FROM full_lines GROUP BY line
), firsts AS (
  SELECT * FROM starts WHERE size >= 24
), cuts AS (
  SELECT size, k, size // 3 * k + greatest(k - (3 - size % 3), 0) AS begin_at, size // 3 + CASE WHEN k >= 3 - size % 3 THEN 1 ELSE 0 END AS n
  FROM (SELECT DISTINCT size - d AS size FROM firsts, range(3) r(d)), range(3) s(k)
), probes AS (
  SELECT f.line, f.size, f.first, c.size AS other_size, c.k, substr(f.line, c.begin_at + m.moved + 1, c.n) AS part
  FROM firsts f JOIN cuts c ON c.size BETWEEN f.size - 2 AND f.size
  JOIN (SELECT unnest([-2, -1, 0, 1, 2]) AS moved) m ON c.begin_at + m.moved >= 0
), near AS (
  SELECT DISTINCT CASE WHEN s.first < p.first THEN p.line ELSE s.line END AS line
  FROM (SELECT * FROM probes WHERE size = other_size) s JOIN probes p
    ON s.size = p.other_size AND s.k = p.k AND s.part = p.part AND s.line <> p.line
  WHERE levenshtein(s.line, p.line) <= 2
), gone AS (
  SELECT l.doc_id, l.line_no FROM full_lines l JOIN starts f USING (line)
  WHERE struct_pack(d := l.doc_id, n := l.line_no) <> f.first OR l.line IN (SELECT line FROM near)
), kept AS (
  SELECT x.doc_id, count(g.line_no) AS n_gone,
    coalesce(string_agg(x.raw, chr(10) ORDER BY x.line_no) FILTER (WHERE g.line_no IS NULL), '') AS text
  FROM (SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no,
      unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents) x
  LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.line_no = x.line_no
  GROUP BY x.doc_id
)
SELECT doc_id, CAST(n_gone AS INTEGER) AS n_gone, CAST(length(text) AS BIGINT) AS kept_chars, md5(text) AS kept_md5 FROM kept
"""

ORACLES["op5_lattice"] = r"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_max([abs(x) FOR x IN embedding]) > 0
), links AS (
  SELECT a.vec_id AS one, b.vec_id AS other FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(vec_id, other) AS (
  SELECT one, other FROM links UNION SELECT r.vec_id, l.other FROM reach r JOIN links l ON l.one = r.other
), smallest AS (
  SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id
), counts AS (
  SELECT one AS vec_id, count(*) AS n FROM links GROUP BY one
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(s.other, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(s.other, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN smallest s USING (vec_id) LEFT JOIN counts c USING (vec_id)
"""

ORACLES["op11_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, list_transform(range(len(w)), lambda i: {i: i, w: w[i + 1]}) AS ws, len(w) AS n
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)
), word AS (
  SELECT r, unnest(ws).i AS i, unnest(ws).w AS w FROM words
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w || chr(10) || w2 || chr(10) || w3) AS k FROM (
    SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE w3 IS NOT NULL
), again AS (
  SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM windows, range(3) s(d) WHERE k > 1 GROUP BY r
), tops AS (
  SELECT r, max(k) AS top, sum(CASE WHEN lettered THEN k END) AS lettered
  FROM (SELECT r, w, count(*) AS k, regexp_matches(w, '\p{L}') AS lettered FROM word GROUP BY r, w) GROUP BY r
), line AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), filled AS (
  SELECT r, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_counts AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (contains('-*•‣◦', left(bare, 1))) AS marked,
    count(*) FILTER (suffix(bare, '...') OR suffix(bare, '…')) AS faded FROM filled GROUP BY r
), counts AS (
  SELECT d.doc_id, w.n AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
    coalesce(a.n_repeat_words, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines, coalesce(l.marked, 0) AS marked,
    coalesce(l.faded, 0) AS faded, coalesce(t.top, 0) AS top, coalesce(t.lettered, 0) AS lettered,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters
  FROM docs d JOIN words w USING (r) LEFT JOIN again a USING (r) LEFT JOIN tops t USING (r) LEFT JOIN line_counts l USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines AND word_chars BETWEEN 2 * n_words AND 12 * n_words
    AND 10 * lettered >= 7 * n_words AND 2 * capitals <= letters AND 4 * top <= n_words
    AND 10 * marked <= 9 * n_lines AND 2 * faded <= n_lines AS kept
FROM judged
"""

ORACLES["op13_ranked_search"] = r"""
WITH item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM doc WHERE len(terms) > 0
), posting AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM posting, total GROUP BY term, n_docs
), scored AS (
  SELECT i.item_id, d.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(d.terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item i JOIN posting p USING (term) JOIN weights USING (term) JOIN doc d USING (r), total GROUP BY i.item_id, d.r, d.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
