"""Writes over stored postings move the lines that stay once, and shuffle keys only."""

import os

import pytest
from pyspark.sql import functions as F

from rolecall import session
from rolecall.plans import inputs as I
from rolecall.sources import readers, writers


def _docs(spark, rows):
    return spark.createDataFrame(rows, "job_key string, company string")


@pytest.mark.parametrize("bits", [8, 64, 1 << 27])
def test_lines_without_new_keys(bits, spark):
    old = _docs(spark, [(f"k{i}", "a") for i in range(300)] + [("k7", "b"), (None, "c")])
    fresh = _docs(spark, [(f"k{i}", "x") for i in range(0, 400, 3)] + [("k0", "y")])
    kept = sorted(tuple(r) for r in writers.without_keys(old, fresh, bits=bits).collect() if r.job_key)
    assert kept == sorted([(f"k{i}", "a") for i in range(300) if i % 3] + [("k7", "b")])
    with_null = writers.without_keys(old, _docs(spark, [(None, "z")]), bits=bits)
    assert with_null.count() == 301 and with_null.filter("job_key IS NULL").count() == 0
    assert with_null.columns == old.columns


def _copies(spark):
    top = os.path.join(session.shared_folder(spark).removeprefix("file:"), "rolecall")
    return {n for n in os.listdir(top) if n.startswith("postings-")} if os.path.isdir(top) else set()


def test_lines_are_stored_once_a_write(spark):
    path, before = session.work_path(spark, "rewrites"), _copies(spark)
    writers.write_postings(_docs(spark, [("a", "1"), ("b", "1"), (None, "1")]), path)
    assert _copies(spark) == before
    for company in "23456":
        writers.write_postings(_docs(spark, [("b", company), (None, company)]), path)
    assert len(_copies(spark) - before) == 5
    found = readers.read_postings(spark, path).select("job_key", "company").collect()
    assert {tuple(r) for r in found} == {("a", "1"), ("b", "6"), (None, "6")} and len(found) == 3


def test_postings_meet_labels_of_their_id_without_a_shuffle_of_texts(spark, tmp_path):
    rows = [(1, "one", "en", "web"), (2, "two", "de", "web"), (2, "zwei", "fr", "book"), (None, "none", "en", "web"), (3, None, None, "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(str(tuple(r)) for r in I.labelled_postings(spark, str(tmp_path)).select("doc_id", "description", "lang", "origin.source").collect())
    assert found == sorted(str(r) for r in [
        (1, "one", "en", "web"), (2, "two", "de", "web"), (2, "two", "fr", "book"), (2, "zwei", "de", "web"), (2, "zwei", "fr", "book"), (3, None, None, "web"),
    ])


def test_contact_lists_are_replaced_in_one_join(spark):
    kind = "job_key string, rest string, part int, recruiters array<string>"
    docs = spark.createDataFrame(
        [("a", "r", 0, ["1"]), ("a", None, 1, ["2"]), ("b", "s", None, None), ("c", "t", 0, ["3"]), ("c", None, 1, ["4"]), (None, "u", None, ["5"])], kind
    )
    new = spark.createDataFrame([("a", 0, ["x"]), ("a", 1, ["y"]), ("a", 2, ["z"]), ("b", 0, ["w"]), ("d", 0, ["v"])], "job_key string, part int, recruiters array<string>")
    rows = writers.upsert_contacts(docs, new)
    assert rows.columns == docs.columns and rows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, [
        ("a", "r", 0, ["x"]), ("a", None, 1, ["y"]), ("a", None, 2, ["z"]), ("b", "s", 0, ["w"]),
        ("c", "t", 0, ["3"]), ("c", None, 1, ["4"]), (None, "u", None, ["5"]),
    ]))
