"""Listings worked out on the executors, against Spark's own."""

import os

from pyspark.sql import functions as F

from rolecall.sources import readers
from rolecall.sources.listing import list_files


def _put(folder, name, at):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("x" * (at % 7))
    os.utime(folder / name, ns=(at, 1_700_000_000_123_456_789 + at * 1_000_000))


def test_same_as_sparks_own_listing(spark, tmp_path):
    root = tmp_path / "a b"
    at = 0
    for folder in ("", "_part=1", "_part=2/deep/er", "_hidden", ".dot", "ü %41#", "empty"):
        (root / folder).mkdir(parents=True, exist_ok=True)
        for name in ("one.json", "two words.json", "no.txt", "_SUCCESS.json", ".crc.json", "é+&=[1].json"):
            if folder != "empty":
                _put(root / folder, name, at := at + 1)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    # Spark's reader takes a path as a pattern, so it is given the folder above; it leaves empty files out
    expected = reader.load(str(tmp_path)).select("path", "modificationTime", "length")
    got = list_files(spark, str(root), ".json")
    assert got.schema.simpleString() == expected.schema.simpleString()
    full = got.filter("length > 0")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, expected.collect())) and got.count() == 12 > full.count()
    listed = [(r.modificationTime, r.path) for r in readers.list_postings(spark, str(root)).collect()]
    assert listed == sorted(listed, key=lambda x: (-x[0].timestamp(), x[1]))
    assert list_files(spark, str(root / "empty"), ".json").count() == 0
    assert list_files(spark, str(tmp_path / "none"), ".json").count() == 0
    assert [r.length for r in list_files(spark, str(root / "one.json"), ".json").collect()] == [1]


def test_many_files(spark, tmp_path):
    for part in range(40):
        folder = tmp_path / f"_part={part}"
        folder.mkdir()
        for at in range(50):
            (folder / f"{at}.json").touch()
    got = list_files(spark, str(tmp_path), ".json")
    assert got.count() == 2000 and got.select("path").distinct().count() == 2000
    assert got.filter(F.col("length") != 0).count() == 0
