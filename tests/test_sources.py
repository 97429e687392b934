import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from rolecall import schemas
from rolecall.operators import postings
from rolecall.sources import readers, writers


def test_posting_round_trip(spark, tmp_path):
    rows = [
        ("a__dev__1", "https://x.com/1", "lever", "Dév", "Ä & Co", "Research", None, "line\nline", None, None, dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("b__dev__1", "https://x.com/2", "generic", "", "", "Other", "Rome", "", "s", "b", None),
    ]
    df = spark.createDataFrame(rows, schemas.POSTINGS)
    path = str(tmp_path / "out")
    writers.write_postings(df, path)
    back = readers.read_postings(spark, path).select(df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    writers.write_postings(df.filter("job_key = 'b__dev__1'").withColumn("company", F.lit("New")), path)
    found = {r.job_key: r.company for r in readers.read_postings(spark, path).collect()}
    assert found["b__dev__1"] == "New" and found["a__dev__1"] == "Ä & Co" and len(found) == 2
    listed = readers.list_postings(spark, path).collect()
    assert len(listed) == 2 and all(r.path.endswith(".json") for r in listed)
    assert readers.list_postings(spark, str(tmp_path / "none")).count() == 0


def test_listing_is_newest_first(spark, tmp_path):
    for at, name in enumerate(["b.json", "a.json", "c.json", "d.txt"]):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (1_700_000_000 + at, 1_700_000_000 + at))
    names = [r.path.rsplit("/", 1)[1] for r in readers.list_postings(spark, str(tmp_path)).collect()]
    assert names == ["c.json", "a.json", "b.json"]


def test_posting_files(spark, tmp_path):
    doc = {
        "job_key": "k", "company": "Acme", "unknown": 1,
        "recruiters": [
            {"name": "Jane Doe", "email": " a@x.com ,, b@x.com", "email_tried": ["a@x.com"], "email_bounced": True,
             "email_sent_at": "2024-01-01T00:00:00Z"},
            {"name": "No Mail", "email": None, "source": "brave [x]"},
        ],
    }
    (tmp_path / "one.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"job_key": "none"}, indent=2))
    (tmp_path / "three.json").write_text(json.dumps({"job_key": "empty", "recruiters": []}, indent=2))
    docs = readers.read_posting_files(spark, str(tmp_path))
    got = readers.contacts_from_docs(docs).orderBy("contact_rank").collect()
    assert [(r.job_key, r.contact_rank, r.name, r.candidates, r.source, r.email_tried, r.email_bounced) for r in got] == [
        ("k", 1, "Jane Doe", ["a@x.com", "b@x.com"], "google", ["a@x.com"], True),
        ("k", 2, "No Mail", [], "brave [x]", [], None),
    ]
    assert got[0].email_sent_at == dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("size", [2, 1000])
def test_nested_contacts_keep_long_lists(spark, size):
    contacts = spark.range(1, 8).select(
        F.lit("j").alias("job_key"), F.col("id").cast("int").alias("contact_rank"),
        F.concat(F.lit("n"), F.col("id")).alias("name"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("linkedin_url"), F.array(F.lit("a@x.com"), F.lit("b@x.com")).alias("candidates"),
        F.lit("brave").alias("source"), F.lit(None).cast("timestamp").alias("found_at"),
        F.lit(None).cast("timestamp").alias("email_sent_at"), F.lit(None).cast("string").alias("email_sent_to"),
        F.array().cast("array<string>").alias("email_tried"), F.lit(None).cast("boolean").alias("email_bounced"),
    )
    nested = writers.nested_contacts(contacts, size)
    assert nested.count() == (4 if size == 2 else 1)
    posts = spark.createDataFrame([("j", "Acme"), ("k", "Bee")], "job_key string, company string")
    docs = posts.join(nested, "job_key", "left")
    assert sorted(map(str, readers.contacts_from_docs(docs, size).select(contacts.columns).collect())) == sorted(map(str, contacts.collect()))
    new = writers.nested_contacts(contacts.filter("contact_rank <= 3").withColumn("name", F.lit("new")), size)
    replaced = writers.upsert_contacts(docs, new)
    got = readers.contacts_from_docs(replaced, size).orderBy("contact_rank").collect()
    assert [(r.contact_rank, r.name) for r in got] == [(1, "new"), (2, "new"), (3, "new")]
    assert {r.company for r in replaced.collect()} == {"Acme", "Bee"}


def test_text_documents_and_prompts(spark, tmp_path):
    (tmp_path / "cv.txt").write_text("\n  Jane's resume\nline two \n\n")
    (tmp_path / "cv.md").write_text("no")
    resume = readers.read_text_docs(spark, str(tmp_path))
    assert [r.text for r in resume.collect()] == ["Jane's resume\nline two"]
    job = spark.createDataFrame(
        [("Acme", "Dev", "u", "d" * 4000)], "company string, job_title string, url string, description string"
    )
    prompt = postings.with_draft_prompt(job, resume).collect()[0].prompt
    assert "d" * 3000 in prompt and "d" * 3001 not in prompt and "Jane's resume\nline two" in prompt
    text = spark.createDataFrame([("é" * 9000,)], "raw_text string")
    prompt = postings.with_analysis_prompt(text).collect()[0].prompt
    assert "é" * 8000 in prompt and "é" * 8001 not in prompt and "- Data Science / ML" in prompt


def test_other_readers(spark, tmp_path, sf_dir):
    assert readers.read_pages(spark, f"{sf_dir}/pages.parquet").columns == ["page_id", "url", "html"]
    line = {"message_id": 1, "received_at": "2024-01-01T00:00:00Z", "sender": "s", "headers": [{"name": "To", "value": "v"}]}
    (tmp_path / "n.json").write_text(json.dumps(line))
    row = readers.read_notices(spark, str(tmp_path)).collect()[0]
    assert row.headers[0].value == "v" and row.received_at == dt.datetime(2024, 1, 1)


def test_unknown_keys_come_back(spark, tmp_path):
    path = tmp_path / "docs" / "_part=1"
    path.mkdir(parents=True)
    line = {
        "job_key": "k", "company": "Acme", "note": "\u00e4 \"x\"\t,", "deep": {"list": [1, 2.5, None, {"a": "b"}]}, "n": 7, "recruiters": [],
    }
    other = '{"job_key": "other",  "kept": "as  it \\u00e4 was, \\"so\\""}'
    key_part = int(hashlib.md5(b"k").hexdigest()[:4], 16) % 64
    folder = tmp_path / "docs" / f"_part={key_part}"
    folder.mkdir(exist_ok=True)
    (folder / "a.json").write_text(json.dumps(line) + "\n" + other + "\n")
    docs = readers.read_postings(spark, str(tmp_path / "docs")).filter("job_key = 'k'")
    drafts = docs.select("job_key", F.lit("s, \"t\"").alias("email_subject"), F.lit("b\nc\x01").alias("email_body"))
    writers.write_postings(postings.apply_drafts(docs, drafts), str(tmp_path / "docs"))
    lines = [raw for f in folder.glob("*.json") for raw in f.read_text().splitlines()]
    assert other in lines and len(lines) == 2
    found = json.loads(next(raw for raw in lines if raw != other))
    assert found == {**line, "email_subject": "s, \"t\"", "email_body": "b\nc\x01"}


def test_own_columns_win_over_rest(spark):
    df = spark.createDataFrame([("k", "new", '{"label": "old", "n": 1}')], "job_key string, label string, r string")
    df = df.withColumn("rest", F.from_json("r", schemas.REST)).drop("r")
    assert json.loads(df.select(writers.document_line(df.columns)).first()[0]) == {"job_key": "k", "label": "new", "n": 1}
