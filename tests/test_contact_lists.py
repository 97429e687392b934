"""Contact lists are numbered, nested and put into their documents in one move of their rows."""

import os

from pyspark.sql import functions as F

from rolecall import session
from rolecall.functions import names as N
from rolecall.functions import text as T
from rolecall.operators import outreach
from rolecall.operators.skew import numbered
from rolecall.plans.queries import QUERIES
from rolecall.sources import readers, writers


def _tables(spark, folder):
    nations = [(0, "CHINA", 0), (1, "PERU", 1)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "ASIA"), (1, "AMERICA")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    customers = [(k, f"Customer{k}", k % 2, 1.0, "BUILDING") for k in range(6)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    orders = spark.range(120).select(
        (F.col("id") * 40_009).alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"),
        F.element_at(F.array(F.lit("O"), F.lit("F"), F.lit("P")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.expr("timestamp_ntz'1998-01-01 00:00:00'").alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"),
    )
    orders.write.parquet(f"{folder}/orders.parquet")


def _folders(spark, name):
    top = os.path.join(session.shared_folder(spark).removeprefix("file:"), "rolecall")
    return {n for n in os.listdir(top) if n.startswith(f"{name}-")} if os.path.isdir(top) else set()


def test_sent_lists_are_not_stored_between(spark, tmp_path):
    _tables(spark, str(tmp_path))
    before = _folders(spark, "sent")
    rows = QUERIES["contact_documents"](spark, str(tmp_path))
    found = rows.collect()
    assert _folders(spark, "sent") == before
    ranks = {}
    for r in found:
        ranks.setdefault(r.job_key, []).append(r.contact_rank)
    assert {k: sorted(v) for k, v in ranks.items()} == {f"c{k}": list(range(1, 25)) for k in range(5)}
    # lists of even postings hold what was sent, the others are as they were
    replaced = QUERIES["replaced_contacts"](spark, str(tmp_path)).collect()
    assert sorted((r.job_key, r.tried) for r in found) == sorted((r.job_key, r.tried) for r in replaced)


def test_nested_lists_move_once(spark):
    contacts = spark.range(40).select(
        F.concat(F.lit("j"), F.col("id") % 4).alias("job_key"), F.col("id").alias("order_no"), F.col("id").cast("string").alias("name"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("linkedin_url"), F.array(F.lit("a@x.com")).alias("candidates"),
        F.lit("brave").alias("source"), F.lit(None).cast("timestamp").alias("found_at"), F.lit(None).cast("timestamp").alias("email_sent_at"),
        F.lit(None).cast("string").alias("email_sent_to"), F.array().cast("array<string>").alias("email_tried"), F.lit(None).cast("boolean").alias("email_bounced"),
    )
    nested = writers.nested_contacts(numbered(contacts, ["job_key"], "order_no", "contact_rank"), 3)
    text = nested._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "lambda" not in text
    assert nested.schema["recruiters"].dataType.elementType.names[0] == "name"
    lists = {(r.job_key, r.part): [int(c.name) for c in r.recruiters] for r in nested.collect()}
    assert lists == {(f"j{j}", p): list(range(j, 40, 4))[3 * p : 3 * p + 3] for j in range(4) for p in range(4)}


def test_words_and_addresses_with_any_blanks(spark):
    blank = "  \t"
    rows = [(" a  b ",), (f"a{blank}b",), ("a\nb",), ("a\x1fb",), ("",), ("  ",), (None,), ("été b",)]
    found = [r[0] for r in spark.createDataFrame(rows, "c string").select(T.words(F.col("c"))).collect()]
    assert found == [["a", "b"]] * 4 + [[], [], None, ["été", "b"]]
    rows = [("a@x,b@x",), (" a@x , b@x",), (f"{blank}a@x,,b@x{blank}",), (",,",), (" , ",), ("",), (None,), ("é@x,a b",)]
    found = [r[0] for r in spark.createDataFrame(rows, "c string").select(readers.split_addresses(F.col("c"))).collect()]
    assert found == [["a@x", "b@x"]] * 3 + [[]] * 4 + [["é@x", "a b"]]


def test_first_long_word_after_the_first(spark):
    rows = [("Ann B. Cole",), ("Ann Cole.. Dee",), ("Ann B. C.",), ("Ann ... Cole",), ("Ann",), (None,)]
    df = spark.createDataFrame(rows, "name string")
    assert [r["last"] for r in N.with_first_last(df, "name").orderBy("name").select("name", "last").collect()] == [None, None, "cole", "b", "cole", "cole"]


def test_sendable_looks_at_untried_addresses(spark):
    kind = "candidates array<string>, email_tried array<string>, email_sent_at string, email_bounced boolean"
    rows = [(["a", "b"], ["a"], "t", True), (["a"], ["a"], "t", True), (["a", "b"], ["a"], "t", False), (["a"], [], None, None), ([], [], None, None), (["a", "b"], ["a"], "t", None)]
    assert [bool(r[0]) for r in spark.createDataFrame(rows, kind).select(outreach.sendable()).collect()] == [True, False, False, True, False, False]
