"""Plans read only what they need, and results do not depend on the partitioning."""

import datetime as dt

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from rolecall.operators import pages
from rolecall.plans import pipeline
from rolecall.plans.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark, sf_dir):
    plan = plan_of(QUERIES["top_domains"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan and "html" not in plan
    plan = plan_of(QUERIES["outreach_summary"](spark, sf_dir))
    assert "o_totalprice" not in plan and "c_acctbal" not in plan


@pytest.mark.parametrize("name", ["top_domains", "found_contacts", "pattern_votes", "outbox", "bounce_reconcile", "query_yields"])
def test_partitioning_does_not_matter(name, spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = spark_rows(QUERIES[name](spark, sf_dir))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert spark_rows(QUERIES[name](spark, sf_dir)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_posting_run(spark):
    pages = spark.createDataFrame(
        [("http://x.com/1?ref=a", "<title>T1</title><p>text"), ("http://x.com/2", "<nav>n</nav>"), ("http://x.com/3", "<p>three")],
        "url string, html string",
    )
    answers = spark.createDataFrame(
        [("https://x.com/1", '{"company":"Acme","job_family":"Legal / x"}'), ("https://x.com/2", "{}"), ("https://x.com/3", "oops")],
        "canonical_url string, response string",
    )
    good, bad = pipeline.posting_run(pages, answers, F.expr("timestamp'2024-01-02 03:04:05'"))
    row = good.collect()[0]
    assert good.count() == 1
    assert (row.job_key, row.job_title, row.job_family) == ("acme__t1__20240102_030405", "T1", "Legal / Compliance")
    assert {(r.canonical_url, r.problem) for r in bad.collect()} == {
        ("https://x.com/2", "no text extracted"), ("https://x.com/3", "not json")
    }


def test_send_run(spark):
    t = dt.datetime(2024, 1, 1)
    contacts = spark.createDataFrame(
        [("j", 1, "Jane Doe", ["a@x.com", "b@x.com"], ["a@x.com"], t, "a@x.com", None)],
        "job_key string, contact_rank int, name string, candidates array<string>, email_tried array<string>,"
        " email_sent_at timestamp, email_sent_to string, email_bounced boolean",
    )
    jobs = spark.createDataFrame([("j", "s", "Hi there,")], "job_key string, email_subject string, email_body string")
    notices = spark.createDataFrame(
        [(1, t, "postmaster@x", [{"name": "To", "value": "A@x.com"}])],
        "message_id bigint, received_at timestamp, sender string, headers array<struct<name:string,value:string>>",
    )
    checked, out = pipeline.send_run(contacts, jobs, notices, F.lit(t), 30)
    assert checked.collect()[0].email_bounced is True
    assert [(r.to_address, r.body, r.attempt_label) for r in out.collect()] == [("b@x.com", "Hi Jane,", "[retry 2/2]")]


def test_stored_keys_are_filtered_before_any_shuffle(spark, tmp_path):
    spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    rows = spark.range(199_990, 200_020).select(F.col("id").cast("string").alias("k"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    got = pages.unseen(rows, stored, ["k"])
    plain = rows.join(stored.select("k").distinct(), "k", "left_anti")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() == 21
    met = pages.may_hold(stored.select("k"), rows, ["k"])
    assert 10 <= met.count() <= 20  # far below the stored rows
    plan = plan_of(met)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "v#" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # that of the bitmap's blocks: stored rows stay where they are read
    dense = pages.may_hold(stored.select("k"), stored, ["k"], bits=1 << 15)
    assert dense.count() == 200_000  # a full filter lets all pass: never fewer than the keys that are there
