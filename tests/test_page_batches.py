"""Pages reach Python few at a time, whatever the session says of Arrow batches."""

import pytest

from rolecall.functions.html import page_facets
from rolecall.plans.queries import QUERIES


@pytest.mark.parametrize("name", ["profile_contacts", "result_page_contacts", "page_links", "page_texts"])
def test_no_arrow_batches_of_pages(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("BatchEvalPython") == 1


def test_facets_of_odd_pages(spark):
    link = '<a href="/x?a=1&amp;b" class="c d">one <b>two</b></a>'
    pages = [(0, None), (1, ""), (2, f"<title>T</title><p>é\U0001f600</p>{link}"), *((i, f"<p>{i}</p>") for i in range(3, 503))]
    rows = spark.createDataFrame(pages, "no int, html string").coalesce(1)
    found = {r.no: r.page for r in rows.select("no", page_facets(rows.html, "text", "title", "jsonld", "links").alias("page")).collect()}
    assert len(found) == len(pages) and all(found[i].text == str(i) and found[i].links == [] for i in range(3, 503))
    assert found[0] == found[1] and tuple(found[0]) == ("", None, None, [])
    assert (found[2].text.splitlines()[1], found[2].title) == ("é\U0001f600", "T")
    assert [tuple(a) for a in found[2].links] == [("/x?a=1&b", "one  two", "c d")]
