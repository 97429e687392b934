import os
import subprocess
import sys
import time

from pyspark.sql import functions as F

from rolecall.functions import html as H
from rolecall.operators import pages

PAGE = """<!DOCTYPE html><html><head><title> A &amp; B </title><style>p{}</style>
<script>var t="</p><b>no</b>";</script><script type="application/ld+json">{"title":"T"}</script></head>
<body><header>top</header><nav><ul><li>menu<li>more</ul></nav><!-- c --><p>One <b>two</b>&nbsp;three
<p>Caf&eacute; &lt;x&gt;<img src="a>b"><svg><text>pic</text></svg><form><input>ask</form>
<iframe>frame</iframe><noscript>off</noscript><aside>side</aside><template>hidden</template>
<div title="a > b">four</div></p></div>five<footer>end</footer></body></html>"""


def test_text():
    page = H.scan(PAGE)
    assert H.clean_lines(page.text) == "A & B\nOne\ntwo\nthree\nCafé <x>\nfour\nfive"
    assert page.title == "A & B"
    assert page.jsonld == '{"title":"T"}'


def test_broken_markup():
    assert H.clean_lines(H.scan("<div><nav>menu</div>text").text) == "text"
    assert H.clean_lines(H.scan("<nav>menu</p>still</nav>text").text) == "text"
    assert H.clean_lines(H.scan("a < b <b>c").text) == "a < b\nc"
    assert H.clean_lines(H.scan("<script>never closed <b>x").text) == ""
    assert H.clean_lines(H.scan("x<!-- open").text) == "x"
    assert H.clean_lines(H.scan("</b></div>x").text) == "x"


def test_links_and_sections():
    page = H.scan(
        '<a class="result__a x" href="/l?a=1&amp;b=2">Jane <b>Doe</b> &amp; co</a><a name=n>no</a><a href=/y>z</a>'
    )
    assert [(a["href"], " ".join(a["parts"]), a["css"]) for a in page.links] == [
        ("/l?a=1&b=2", "Jane  Doe  & co", "result__a x"), ("/y", "z", "")
    ]
    blocks = H.scan(
        '<div class="section page-centered">a<nav>n</nav><svg>kept</svg><div>b</div></div>'
        '<div class="section">no</div><div class="page-centered last section">c</div>'
    ).sections
    assert ["\n".join(b) for b in blocks] == ["a\nkept\nb", "c"]


def test_page_jobs(spark):
    rows = [("http://x.com/a?ref=1", PAGE), ("http://x.com/b", "<nav>only</nav>"), ("http://x.com/c", None)]
    texts = pages.page_texts(spark.createDataFrame(rows, "url string, html string"))
    good, bad = pages.split_success(texts)
    assert [(r.canonical_url, r.page_title) for r in good.collect()] == [("https://x.com/a", "A & B")]
    assert {(r.canonical_url, r.error) for r in bad.collect()} == {
        ("https://x.com/b", "no text extracted"), ("https://x.com/c", "no text extracted")
    }
    long = spark.createDataFrame([("u", "<p>" + "é" * 13000)], "url string, html string")
    assert pages.page_texts(long).select(F.length("raw_text").alias("n")).collect()[0].n == 12000


def test_lever_and_ats(spark):
    ld = '<script type="application/ld+json">{"title":"Dev","hiringOrganization":null,"jobLocation":{"address":{"addressLocality":"Rome"}}}</script>'
    block = '<div class="section page-centered">%s</div>'
    rows = [
        ("https://jobs.lever.co/a/1", ld + block % "one" + block % "two" + block % "legal"),
        ("https://jobs.lever.co/a/2", "<title>T2</title>" + block % "only"),
        ("https://jobs.lever.co/a/3", "<title>T3</title><p>plain"),
        ("https://jobs.lever.co/a/4", "<nav>x</nav>"),
    ]
    got = {r.url[-1]: r for r in pages.lever_texts(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got["1"].raw_text == "Job Title: Dev\nCompany: \nLocation: Rome\n\none\n\ntwo"
    assert got["1"].page_title == "Dev at "
    assert got["2"].raw_text == "Job Title: T2\nCompany: \nLocation: \n\nonly"
    assert got["3"].raw_text.endswith("\n\nT3\nplain")
    assert (got["4"].success, got["4"].error, got["4"].raw_text) == (False, "no description found", "")
    bodies = [
        ("https://boards.greenhouse.io/acme/jobs/1", '{"title":"Dev","offices":[{"name":"Rome"},{"id":1},{"name":"Oslo"}],"content":"&lt;p&gt;A &amp;amp; B&lt;/p&gt;&lt;script&gt;x&lt;/script&gt;"}'),
        ("https://boards.greenhouse.io/acme/jobs/2", "{}"),
        ("https://boards.greenhouse.io/acme/jobs/3", "<html>busy"),
        ("https://boards.greenhouse.io/acme/jobs/4", None),
        ("https://boards.greenhouse.io/acme/jobs/5", '{"title":"Old","title":"New"}'),
    ]
    got = {r.url[-1]: r for r in pages.ats_texts(spark.createDataFrame(bodies, "url string, body string")).collect()}
    assert got["1"].raw_text == "Job Title: Dev\nCompany: acme\nLocation: Rome, , Oslo\n\nA & B"
    assert got["2"].raw_text == "Job Title: \nCompany: acme\nLocation: \n\n"
    assert got["1"].page_title == "Dev at acme"
    assert [(got[n].success, got[n].error, got[n].raw_text) for n in "34"] == [(False, "unreadable answer", "")] * 2
    assert got["5"].success and got["5"].title == "New"


def test_pass_travels_without_the_package(tmp_path):
    """Workers started elsewhere do not have this repository on their path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from rolecall.session import local_session\nfrom rolecall.operators import pages\n"
        "s = local_session(2)\n"
        "d = s.createDataFrame([('http://x/a', '<div class=\"section page-centered\"><p>hello</div>')], 'url string, html string')\n"
        "assert pages.lever_texts(d).collect()[0].success\nprint('done')\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "done" in out.stdout, out.stderr[-2000:]


def test_broken_pages_of_a_megabyte_are_linear():
    million = 1_000_000
    bad = {
        "unclosed tags": "<a" * (million // 2),
        "unclosed tags before a bracket": "<a " * (million // 3) + ">",
        "odd quotes": "<a \"<b '" * (million // 8) + ">",
        "unmatched end tags": "<b>" * (million // 8) + "</i>" * (million // 8),
        "end tags behind a stronger element": "<span><div>" + "<b>" * (million // 8) + "</span>" * (million // 12),
        "nested links": "<a href=x><div>text" * (million // 19),
        "open declarations": "<!x " * (million // 4),
    }
    for name, page in bad.items():
        began = time.process_time()
        H.scan(page)
        assert time.process_time() - began < 5, name
