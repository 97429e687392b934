"""Keyed tables that grow batch by batch: bounded folders and reads, and no row lost or repeated when a driver dies."""

import random

import pytest
from pyspark.sql import functions as F

from rolecall.session import work_path
from rolecall.sources import folders
from rolecall.sources.segments import Segments

SCHEMA = "contact long, attempt int, n long"
KEYS = ["contact", "attempt"]


def batch_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def content(table):
    return sorted(((r.contact, r.attempt, r.n) for r in table.rows().collect()), key=str)


def test_rows_once_and_folders_bounded(spark):
    table = Segments(spark, work_path(spark, "seg"), KEYS, buckets=4, fan=3)
    rng, first, read = random.Random(1), {}, []
    for no in range(24):
        rows = [(rng.randrange(40), rng.randrange(3), no * 100 + i) for i in range(5)] + [(None, 1, no)]
        for c, a, n in sorted(rows, key=lambda r: r[2]):
            first.setdefault((c, a), n)
        live = table.manifest()["segments"]
        read.append(len(table.paths(live, {0})))
        table.append(batch_of(spark, rows), no, ["n"])
    assert content(table) == sorted(((c, a, n) for (c, a), n in first.items()), key=str)
    # 24 batches: no more than fan segments on each of three levels, and few files read for one key
    assert len(table.manifest()["segments"]) <= 9 and max(read) <= 9
    assert len(folders.names(spark, f"{table.target}/segments")) <= 16
    assert len(table.versions()) == 2 and folders.names(spark, f"{table.target}/work") == []


def test_a_batch_reads_only_its_keys_folders(spark):
    table = Segments(spark, work_path(spark, "seg"), ["contact"], buckets=16)
    table.append(batch_of(spark, [(i, 1, i) for i in range(500)]), 0, ["n"])
    one = table._bucketed(batch_of(spark, [(7, 1, 0)])).first()[-1]
    live = table.manifest()["segments"]
    assert len(live[0]["buckets"]) == 16
    (path,) = table.paths(live, {one})
    files = spark.read.parquet(path).inputFiles()
    assert len(files) < len(table.rows().inputFiles()) and all(f"_bucket={one}/" in f for f in files)


@pytest.mark.parametrize("step", ["work", "segment", "merge", "manifest", "clean"])
def test_a_lost_driver_neither_loses_nor_repeats(spark, monkeypatch, step):
    """The driver dies after one of the steps of the sixth batch; the batch is run again, then others follow."""
    table = Segments(spark, work_path(spark, "seg"), KEYS, buckets=3, fan=2)
    batches = [[(i, a, 10 * i + a) for a in (1, 2)] + [(0, 1, 10 * i)] for i in range(8)]
    died = []

    def dies(name, after, when=lambda *a: True):
        real = getattr(Segments, name)

        def run(self, *args, **kw):
            if not after and when(*args):
                died.append(step)
                raise KeyboardInterrupt
            found = real(self, *args, **kw)
            if after and when(*args):
                died.append(step)
                raise KeyboardInterrupt
            return found

        monkeypatch.setattr(Segments, name, run)

    for no, rows in enumerate(batches):
        if no == 5:
            before = content(table)
            if step == "work":
                dies("_written", False)
            elif step == "segment":
                dies("_written", True)
            elif step == "merge":
                dies("_merged", True)
            elif step == "manifest":
                dies("_clean", False)
            else:
                dies("_clean", True)
            with pytest.raises(KeyboardInterrupt):
                table.append(batch_of(spark, rows), no, ["n"])
            monkeypatch.undo()
            assert died and (content(table) == before or step in ("manifest", "clean"))
        table.append(batch_of(spark, rows), no, ["n"])
    expected = {}
    for rows in batches:
        for c, a, n in sorted(rows, key=lambda r: r[2]):
            expected.setdefault((c, a), n)
    assert content(table) == sorted((c, a, n) for (c, a), n in expected.items())


def test_empty_batches_and_missing_tables(spark):
    table = Segments(spark, work_path(spark, "seg"), KEYS)
    with pytest.raises(ValueError):
        table.rows()
    table.append(batch_of(spark, []), 0, ["n"])
    assert table.rows().count() == 0 and table.rows().columns == ["contact", "attempt", "n"]
    table.append(batch_of(spark, [(1, 1, 5)]).withColumn("n", F.col("n") + 1), 1, ["n"])
    assert content(table) == [(1, 1, 6)]
