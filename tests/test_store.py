"""The store of postings: parts, versions, and writes that die."""

import os

import pytest
from pyspark.sql import functions as F

from rolecall.sources import folders
from rolecall.sources.store import PostingStore, needed_bits

MOST = 4000


def _rows(spark, start, end, company, size=80):
    return spark.range(start, end).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("job_key"), F.lit(company).alias("company"),
        F.repeat(F.lit("d"), size).alias("description"),
    )


def _found(store, version=None):
    return {r.job_key: r.company for r in store.read(version).collect()}


def _files(store):
    return {
        os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns
        for at, _, names in os.walk(f"{store.target}/parts") for n in names if n.endswith(".json")
    }


def _covers_all(parts):
    spans = sorted((p["prefix"] << (32 - p["depth"]), (p["prefix"] + 1) << (32 - p["depth"])) for p in parts)
    assert spans[0][0] == 0 and spans[-1][1] == 1 << 32
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_needed_bits():
    assert [needed_bits(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_parts_split_and_small_writes_touch_few(spark, tmp_path, monkeypatch):
    store = PostingStore(spark, str(tmp_path / "store"), MOST)
    with pytest.raises(ValueError):
        store.read()
    assert store.write(_rows(spark, 0, 400, "old")) == 1
    parts = store.parts()
    _covers_all(parts)
    assert len(parts) > 8 and len(_found(store)) == 400
    files = _files(store)
    # 1 % of the keys: their parts are written anew, no other is read or touched
    assert store.write(_rows(spark, 0, 4, "new")) == 2
    _covers_all(store.parts())
    assert sum(p["version"] == 2 for p in store.parts()) <= 4 < sum(p["version"] == 1 for p in store.parts())
    after = _files(store)
    assert all(after[f] == at for f, at in files.items())
    expected = {f"k{i}": "new" if i < 4 else "old" for i in range(400)}
    assert _found(store) == expected and set(_found(store, 1).values()) == {"old"}
    # a write that dies before its manifest leaves the version before, and can be run again
    with monkeypatch.context() as m:
        def dies(*_):
            raise OSError("gone")
        m.setattr(folders, "write_text", dies)
        with pytest.raises(OSError):
            store.write(_rows(spark, 390, 500, "third"))
    assert _found(store) == expected and store.versions() == [1, 2]
    assert store.write(_rows(spark, 390, 500, "third")) == 3
    expected |= {f"k{i}": "third" for i in range(390, 500)}
    assert _found(store) == expected and store.versions() == [2, 3]
    # what no kept version names is gone
    named = {store.path(p) for v in (2, 3) for p in store.parts(v) if p["version"]}
    assert {os.path.dirname(f) for f in _files(store)} == named


def test_odd_keys(spark, tmp_path):
    store = PostingStore(spark, str(tmp_path / "store"), 500)
    schema = "job_key string, company string"
    odd = [(None, "none"), ("", "empty"), ('q"\\', "quoted"), ("ü", "umlaut")]
    store.write(spark.createDataFrame(odd, schema))
    assert store.write(spark.createDataFrame([], schema)) == 2
    assert _found(store) == dict(odd)
    # many rows of one key stay together, however large, and go together
    store.write(spark.range(60).select(F.lit("hot").alias("job_key"), F.col("id").cast("string").alias("company")))
    _covers_all(store.parts())
    assert store.read().filter("job_key = 'hot'").count() == 60
    store.write(spark.createDataFrame([("hot", "one"), (None, "nothing")], schema))
    assert _found(store) == {**dict(odd), None: "nothing", "hot": "one"} and store.read().count() == 5


def test_a_replaced_version_goes_as_one_folder(spark, tmp_path, monkeypatch):
    store = PostingStore(spark, str(tmp_path / "store"), MOST)
    removed = []
    remove = folders.remove
    with monkeypatch.context() as m:
        m.setattr(folders, "remove", lambda s, path: (removed.append(path), remove(s, path)))
        for start, company in ((0, "a"), (0, "b"), (0, "c")):
            store.write(_rows(spark, start, 400, company))
    assert len(store.parts()) > 8 and removed == [f"{store.target}/parts/1", f"{store.target}/manifest/1.json"]
    assert set(_found(store).values()) == {"c"} and set(_found(store, 2).values()) == {"b"}
    assert not os.path.exists(f"{store.target}/parts/1")


def test_folders_are_listed_in_few_tasks(spark):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    with folders.few_listing_tasks(spark):
        assert int(spark.conf.get(setting)) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(setting) == before
