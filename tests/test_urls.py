import random
from urllib.parse import parse_qsl, urlencode, urlparse, urlsplit, urlunparse

from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import urls as U
from rolecall.operators import pages


def expected_canonical(url):
    parts = urlparse(url)
    path = parts.path
    for tail in ("/apply/", "/apply"):
        if path.endswith(tail):
            path = path[: -len(tail)]
            break
    first = {}
    for name, value in parse_qsl(parts.query):
        first.setdefault(name, value)
    query = urlencode({k: v for k, v in first.items() if k not in K.TRACKING_PARAMS})
    return urlunparse(("https", parts.netloc, path, parts.params, query, parts.fragment))


def expected_root(url):
    name = (urlsplit(url).hostname or "").removeprefix("www.")
    labels = name.split(".")
    return ".".join(labels[-2:]) if len(labels) > 2 else (name or None)


FIXED = [
    "https://a.com/x/apply?utm_source=f&b=1&b=2&c=&UTM_SOURCE=q",
    "http://a.com/x/apply/?a=x+y%2Fz&t=~*&bad=%zz%20k#top",
    "https://a.com/apply/apply", "jobs.lever.co/x?a=1", "/p?ref=1", "", "x/apply;v=1",
    "https://u:p@A.b.com:8080/x;v=1#", "http://h/a;?q=1&=3&k", "localhost:80/a",
    " http://x.y.z.co.uk/", "http://a.com?x=1", "http://a.com/x/apply;", "HTTP://A.com/Apply",
    "https://www.example.com/about", "https://careers.example.org/jobs/123",
    "https://job-boards.greenhouse.io/acme/jobs/42", "http://[::1]:80/x", "http://localhost/x",
    "https://www.www.com", "https://a.com/x?q=é&z=%C3%A9&y=%41",
]


def random_urls(n=600):
    rng = random.Random(7)
    hosts = ["a.com", "www.b.co.uk", "Jobs.Lever.co", "boards.greenhouse.io:443", "u@h.io", "x"]
    paths = ["", "/", "/a/apply", "/a/apply/", "/apply", "/a;p=1/apply", "/a/b;c", "/a//b/", "/é"]
    names = ["utm_source", "ref", "q", "Q", "a b", "pid", "k%20", "", "src"]
    values = ["", "1", "x y", "a+b", "%2F", "%", "%zz", "=", "~*", "ü", "1=2"]
    for _ in range(n):
        query = "&".join(f"{rng.choice(names)}={rng.choice(values)}" for _ in range(rng.randrange(5)))
        yield (
            rng.choice(["http://", "https://", "//", "", "ftp://"]) + rng.choice(hosts) + rng.choice(paths)
            + (rng.choice(["?", "?", "/"]) + query if query else "") + rng.choice(["", "#", "#frag?x", "#a#b"])
        )


def test_canonical_url_and_domain(spark):
    urls = sorted(set(FIXED) | set(random_urls()))
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    out = U.with_canonical_url(df, "url", "canonical").withColumn("root", U.root_domain(F.col("url")))
    rows = {r.url: r for r in out.collect()}
    assert len(rows) == len(urls)
    for url in urls:
        assert rows[url].canonical == expected_canonical(url), url
        assert rows[url].root == expected_root(url), url


def test_canonical_url_is_stable(spark):
    urls = [u for u in random_urls(200) if u.startswith("http") and "apply" not in u]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    twice = U.with_canonical_url(U.with_canonical_url(df, "url", "one"), "one", "two")
    assert twice.filter("one <> two").count() == 0


def test_platforms_and_ats_ids(spark):
    cases = {
        "https://boards.greenhouse.io/acme/jobs/123?x=1": ("greenhouse", "acme", "123"),
        "https://job-boards.greenhouse.io/acme/jobs/9": ("greenhouse", "acme", "9"),
        "https://boards.greenhouse.io/acme/open/9": ("greenhouse", None, None),
        "https://jobs.lever.co/acme/1": ("lever", None, None),
        "https://clever.com/1": ("lever", None, None),  # matched by substring, so this too
        "https://notlever.co.uk/1": ("lever", None, None),
        "https://acme.wd1.myworkdayjobs.com/x": ("workday", None, None),
        "https://www.workday.com/x": ("workday", None, None),
        "https://example.com/lever.co": ("generic", None, None),
        "https://example.com/boards.greenhouse.io/acme/jobs/7": ("generic", "acme", "7"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    for r in pages.canonical_pages(df).collect():
        assert (r.platform, r.ats_company, r.ats_job_id) == cases[r.url], r.url


def test_board_domains(spark):
    cases = {"lever.co": True, "x.lever.co": True, "clever.co": False, "acme.com": False, "linkedin.com": True}
    df = spark.createDataFrame([(d,) for d in cases], "d string")
    got = {r.d: r.b for r in df.select("d", U.is_board_domain(F.col("d")).alias("b")).collect()}
    assert got == cases


def test_profile_keys_and_redirects(spark):
    profile = "https://www.linkedin.com/in/jane"
    cases = {
        "//duckduckgo.com/l/?uddg=https%3A%2F%2Fwww.linkedin.com%2Fin%2Fjane&rut=1": profile,
        "//duckduckgo.com/l/?rut=1&uddg=https%253A%252F%252Fwww.linkedin.com%252Fin%252Fjane": profile,
        "//duckduckgo.com/l/?uddg=https%3A%2F%2Fx.com%2Fa%252Bb": "https://x.com/a+b",
        profile: profile,
        "https://x.com/?uddg=": None,
        "https://x.com/": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r.u: r.t for r in df.select("u", U.redirect_target(F.col("u")).alias("t")).collect()}
    assert got == cases
    keys = spark.createDataFrame([("HTTPS://X/In/Jane//",), (None,)], "u string")
    assert [r.k for r in keys.select(U.profile_key(F.col("u")).alias("k")).collect()] == ["https://x/in/jane", ""]
