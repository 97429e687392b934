import random

from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.operators import postings, search


def test_query_cascade(spark):
    rows = [
        ("a", "Software Engineering", " Acme ", "Rome, Italy"),
        ("b", "Unlisted", "Acme", None),
        ("c", "Software Engineering", "  ", "Rome"),
        ("d", "Software Engineering", None, "Rome"),
    ]
    jobs = spark.createDataFrame(rows, "job_key string, job_family string, company string, location string")
    got = search.query_cascade(jobs, search.family_terms(spark)).orderBy("job_key", "query_idx").collect()
    site = 'site:linkedin.com/in "Acme" '
    assert [(r.job_key, r.query_idx, r.query, r.term) for r in got] == [
        ("a", 0, site + '"technical recruiter" "Rome"', "technical recruiter"),
        ("a", 1, site + '"technical recruiter"', "technical recruiter"),
        ("a", 2, site + '"engineering recruiter" "Rome"', "engineering recruiter"),
        ("a", 3, site + '"engineering recruiter"', "engineering recruiter"),
        ("a", 4, site + '"talent" "Rome"', "talent"),
        ("a", 5, site + '"talent"', "talent"),
        ("b", 0, site + '"recruiter"', "recruiter"),
        ("b", 1, site + '"talent acquisition"', "talent acquisition"),
        ("b", 2, site + '"talent"', "talent"),
    ]
    assert {r.job_key for r in search.split_searchable(jobs)[1].collect()} == {"c", "d"}


def test_payload_shapes(spark):
    rows = [
        ("brave", '{"web":{"results":[{"url":"u1","title":"t1"},{"title":"t2"}]}}'),
        ("brave", '{"web":{}}'),
        ("tavily", '{"results":[{"url":"u3","content":"c3"}]}'),
        ("google_cse", '{"items":[{"link":"u4","title":"t4"}],"results":[{"url":"no"}]}'),
        ("google_cse", '{"items":[]}'),
        ("tavily", "not json"),
    ]
    hits = search.parse_search_payloads(spark.createDataFrame(rows, "backend string, body string"))
    assert sorted((r.backend, r.hit_rank, r.url, r.title, r.content) for r in hits.collect()) == [
        ("brave", 0, "u1", "t1", ""), ("brave", 1, "", "t2", ""),
        ("google_cse", 0, "u4", "t4", ""), ("tavily", 0, "u3", "", "c3"),
    ]


def test_result_pages(spark):
    html = (
        '<a class="result__a" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fwww.linkedin.com%2Fin%2Fjane">Jane <b>Doe</b> - Boss | LinkedIn</a>'
        '<a class="other" href="https://www.linkedin.com/in/no">No One - x</a>'
        '<a class="result__a" href="https://x.com/">Skip Me - x</a>'
        '<a class="result__a" href="//d/?uddg=https%3A%2F%2Fx.com%2Fin%2Fbob">Bob Ray - y</a>'
        '<a class="result__a" href="https://www.linkedin.com/in/nameless">nameless</a>'
    )
    pages = spark.createDataFrame([("j", "ddg", html)], "job_key string, backend string, html string")
    hits = search.profile_hits(search.result_page_hits(pages))
    assert [(r.hit_rank, r.url, r.name, r.role, r.source) for r in hits.orderBy("hit_rank").collect()] == [
        (0, "https://www.linkedin.com/in/jane", "Jane  Doe", "Boss", "duckduckgo"),
        (2, "https://x.com/in/bob", "Bob Ray", "y", "duckduckgo"),
    ]


def test_outcomes(spark):
    cases = [
        ("ddg", 200, "fine", "ok", None), ("ddg", 202, "", "blocked", None), ("ddg", 429, "", "rate_limited", None),
        ("ddg", 500, "", "error", None), ("ddg", 200, "An ANOMALY", "blocked", None),
        ("ddg", 200, "<form id=challenge-form>", "blocked", None), ("ddg", 200, "Challenge-Form", "ok", None),
        ("ddg", 200, "", "ok", None), ("ddg", None, None, "error", None),
        ("brave", 402, "", "quota", None), ("brave", 429, "", "quota", None), ("brave", 401, "", "bad_key", None),
        ("brave", 404, "", "error", None), ("brave", 200, "anomaly", "ok", None),
        ("tavily", 429, "", "rate_limited", None), ("tavily", 401, "", "bad_key", None), ("tavily", 403, "", "error", None),
        ("google_cse", 429, "", "quota", None), ("google_cse", 403, "", "bad_key", None),
        ("google_cse", 400, '{"error":{"message":"bad cx"}}', "error", "bad cx"),
        ("google_cse", 400, "{}", "error", "Bad request"), ("google_cse", 400, "oops", "error", "Bad request"),
        ("unknown", 200, "", "error", None),
    ]
    log = spark.createDataFrame([c[:3] for c in cases], "backend string, http_status int, body string")
    got = [(r.backend, r.http_status, r.body, r.outcome, r.detail) for r in search.fetch_outcomes(log).collect()]
    assert sorted(got, key=str) == sorted(cases, key=str)


def one_session(ok, queries, backends):
    """Backend per query when a failed backend is never used again."""
    left, used = list(backends), {}
    for q in range(queries):
        while left and not ok.get((q, left[0])):
            left.pop(0)
        if not left:
            break
        used[q] = left[0]
    return used


def test_sticky_backends(spark):
    rng = random.Random(11)
    rows, expected = [], set()
    for job in range(300):
        queries, ok = rng.randrange(1, 7), {}
        for q in range(queries):
            for b in K.BACKENDS:
                if rng.random() < 0.85 or (q, b) == (queries - 1, "ddg"):
                    good = rng.random() < 0.6
                    ok[q, b] = good
                    rows += [(f"j{job}", q, b, "ok" if good else "error")] * rng.choice([1, 1, 2])
        for q, b in one_session(ok, queries, K.BACKENDS).items():
            expected.add((f"j{job}", q, b))
    log = spark.createDataFrame(rows, "job_key string, query_idx int, backend string, outcome string")
    got = search.sticky_backends(log).collect()
    assert {(r.job_key, r.query_idx, r.backend) for r in got} == expected
    assert len(got) == len(expected)


def one_search(hits, max_results):
    """hits: query -> (term, urls). The list as it grows query by query."""
    found, seen, ran = [], set(), []
    for q in sorted(hits):
        term, urls = hits[q]
        if len(found) >= max_results:
            break
        if term == "talent" and found:
            continue
        new = 0
        for rank, url in urls:
            key = url.lower().rstrip("/")
            if key and key not in seen:
                seen.add(key)
                found.append((q, rank))
                new += 1
        ran.append((q, len(urls), new))
    return found[:max_results], ran


def test_contacts_and_yield(spark):
    rng = random.Random(13)
    rows, contacts, yields = [], set(), set()
    for job in range(250):
        hits = {}
        terms = ["a", "a", "b", "b", "talent", "talent"]
        for q in rng.sample(range(6), rng.randrange(1, 7)):
            pool = [f"https://linkedin.com/in/p{rng.randrange(12)}" + rng.choice(["", "/", "//"]) for _ in range(8)]
            pool = [u.upper() if rng.random() < 0.2 else u for u in pool] + [""]
            urls = list(enumerate(rng.sample(pool, rng.randrange(1, 6))))
            hits[q] = (terms[q], urls)
            rows += [(f"j{job}", q, terms[q], rank, url, "brave") for rank, url in urls]
        found, ran = one_search(hits, 5)
        contacts |= {(f"j{job}", at + 1, q, rank, f"brave [{terms[q]}]") for at, (q, rank) in enumerate(found)}
        yields |= {(f"j{job}", q, n, new) for q, n, new in ran}
    df = spark.createDataFrame(
        rows, "job_key string, query_idx int, term string, hit_rank int, url string, source string"
    )
    got = search.capped_contacts(search.first_seen(df)).collect()
    assert {(r.job_key, r.contact_rank, r.query_idx, r.hit_rank, r.source) for r in got} == contacts
    assert len(got) == len(contacts)
    assert {(r.job_key, r.query_idx, r.hits, r.new_hits) for r in search.query_yield(df).collect()} == yields


def test_model_responses(spark):
    cases = [
        ('{"job_title":" Dev ","company":" Acme ","job_family":"Research","location":"Rome"}', ("Dev", "Acme", "Research", "Rome", None)),
        ('```json\n{"job_title":"Dev","company":"A","job_family":"AI / ML"}\n```', ("Dev", "A", "Data Science / ML", None, None)),
        ('```{"job_title":"","company":"A","location":""}```', ("Page", "A", "Other", None, None)),
        ("{}", ("Page", "", "Other", None, None)),
        ('{"job_title":null,"company":"A"}', (None, None, None, None, "field is not text")),
        ('{"job_title":"D","company":7}', (None, None, None, None, "field is not text")),
        ('{"job_title":"D","company":"A","job_family":null}', (None, None, None, None, "field is not text")),
        ('{"job_title":"D","company":"A","location":["x"]}', (None, None, None, None, "location is not text")),
        ('[{"job_title":"D"}]', (None, None, None, None, "not an object")),
        ("Sure! {}", (None, None, None, None, "not json")),
        ('{"job_title":"D"} trailing', (None, None, None, None, "not json")),
        ("", (None, None, None, None, "not json")),
    ]
    df = spark.createDataFrame([(c[0], "Page") for c in cases], "response string, page_title string")
    got = {r.response: (r.job_title, r.company, r.job_family, r.location, r.problem) for r in postings.checked_responses(df).collect()}
    assert got == dict(cases)
    flags = spark.createDataFrame([("N/A", ""), ("Unknown", "x"), ("", "x"), ("Acme", "x")], "company string, job_title string")
    assert [(r.company_doubtful, r.title_blank) for r in postings.quality_flags(flags).collect()] == [
        (True, True), (True, False), (True, False), (False, False)
    ]


def test_default_time_and_drafts(spark):
    df = spark.sql("SELECT 'a' job_key, CAST(NULL AS TIMESTAMP) t, 's0' email_subject, 'b0' email_body UNION ALL SELECT 'b', TIMESTAMP'2020-01-01', NULL, ''")
    out = postings.with_default_time(df, "t", F.expr("TIMESTAMP'2024-01-01'")).orderBy("job_key").collect()
    assert [r.t.year for r in out] == [2024, 2020]
    drafts = spark.sql("SELECT 'b' job_key, 's1' email_subject, 'b1' email_body")
    patched = postings.apply_drafts(df, drafts).orderBy("job_key").collect()
    assert [(r.email_subject, r.email_body) for r in patched] == [("s0", "b0"), ("s1", "b1")]
    ready, lacking = postings.split_drafted(df)
    assert [r.job_key for r in ready.collect()] == ["a"] and [r.job_key for r in lacking.collect()] == ["b"]


def test_unplanned_requests_are_set_aside_and_others_keep_their_result(spark):
    backends = [f"b{i}" for i in range(40)]
    rows = [("j", 0, "b0", "quota"), ("j", 0, "b39", "ok"), ("j", 1, "b0", "ok"), ("j", 1, "b39", "ok"), ("k", None, "b0", "ok"),
            ("j", -1, "b0", "ok"), ("j", 6, "b0", "ok"), ("k", 2, "b7", "ok"), ("k", 2, "other", "ok")]
    log = spark.createDataFrame(rows, "job_key string, query_idx int, backend string, outcome string")
    good, aside = search.split_requests(log)
    assert sorted(map(str, (r.query_idx for r in aside.collect()))) == ["-1", "6", "None"] and good.count() == 6
    used = {(r.job_key, r.query_idx): r.backend for r in search.sticky_backends(log, backends=backends).collect()}
    # 6 x 40 answers are more than one mask holds; b0 failed first and is not tried again; k's first queries had no answer
    assert used == {("j", 0): "b39", ("j", 1): "b39"}
