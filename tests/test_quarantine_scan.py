"""Failed and unanswered pages are found in one pass over the pages."""

from pyspark.sql import functions as F

from rolecall.plans import pipeline


def _pages(spark):
    pages = ["<p>text one", "<nav>n</nav>", "<p>text three", "<p>text four"]
    rows = [(f"https://jobs.example.com/{n}", html) for n, html in enumerate(pages)]
    rows += [("https://jobs.lever.co/acme/1", "<nav>n</nav>"), ("https://jobs.lever.co/acme/2", "<p>lever"), ("https://jobs.example.com/null", None)]
    return spark.createDataFrame(rows, "url string, html string")


def _run(spark):
    good = '{"job_title": "Role", "job_family": "Legal", "company": "Acme"}'
    answers = [("https://jobs.example.com/0", good), ("https://jobs.example.com/1", good), ("https://jobs.example.com/2", "{oops"), ("https://jobs.lever.co/acme/1", "{oops")]
    answers = spark.createDataFrame(answers, "canonical_url string, response string")
    return pipeline.posting_run(_pages(spark), answers, F.expr("timestamp'2024-01-02 03:04:05'"))


def test_quarantine_reads_every_page_once(spark):
    bad = _run(spark)[1]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    # one pass over Lever pages and one over the others
    assert sum(plan.count(f"{node} [") + plan.count(f"{node} rebuilt") for node in ("ArrowEvalPython", "BatchEvalPython")) == 2, plan


def test_failed_pages_keep_their_own_problem(spark):
    good, bad = _run(spark)
    found = {r.canonical_url.removeprefix("https://"): r.problem for r in bad.collect()}
    assert found.pop("jobs.example.com/null", "no text extracted") == "no text extracted"
    assert found == {
        "jobs.example.com/1": "no text extracted", "jobs.lever.co/acme/1": "no description found",
        "jobs.example.com/2": "not json", "jobs.example.com/3": "no answer", "jobs.lever.co/acme/2": "no answer",
    }
    assert [r.url for r in good.collect()] == ["https://jobs.example.com/0"]
