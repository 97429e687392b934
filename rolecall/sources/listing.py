"""Listings of large folder trees, worked out on the executors.

A level of folders at a time: each task lists some folders of the level, and what it finds is stored. Neither names nor
folders pass through the driver, which only learns whether a level held further folders. A single flat folder is listed
by one task, in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecall.session import stored
from rolecall.sources import folders

ENTRIES = "path string, folder string, modificationTime timestamp, length long"
BATCH = 10_000


def _listed(level: DataFrame, scheme: str, authority: str, suffix: str) -> DataFrame:
    """What the folders of a level hold: files (path, time, length) and further folders (folder)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        from pyarrow import fs

        def address(path: str) -> str:
            return f"{scheme}://{authority}" + quote(path, safe="/=:@+,;&$!*()~'")

        # as Spark's own readers show a path
        shown = f"{scheme}://{authority}" if authority else f"{scheme}:"

        def seen(name: str) -> bool:
            return not name.startswith(".") and (not name.startswith("_") or "=" in name)

        times = pa.timestamp("us", tz="UTC")
        types = [pa.string(), pa.string(), times, pa.int64()]
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(address(folder))
                held = system.get_file_info(place)
                found = [held] if held.is_file else system.get_file_info(fs.FileSelector(place, allow_not_found=True))
                rows = []
                for x in found:
                    if x.type == fs.FileType.Directory and seen(x.base_name):
                        rows.append((None, f"{folder.rstrip('/')}/{x.base_name}", None, None))
                    elif x.is_file and seen(x.base_name) and x.base_name.endswith(suffix):
                        inside = folder if held.is_file else f"{folder.rstrip('/')}/{x.base_name}"
                        # file systems differ below a millisecond: Spark's own times have none
                        rows.append((shown + inside, None, x.mtime_ns // 1_000_000 * 1000, x.size))
                for at in range(0, len(rows), BATCH):
                    columns = zip(*rows[at : at + BATCH])
                    arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["path", "folder", "modificationTime", "length"])

    return level.mapInArrow(run, ENTRIES)


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """path, modificationTime, length of all files below ``path``, empty ones too, whose name ends with ``suffix``; a missing path has none.

    Hidden names are left out as Spark's readers leave them out.
    """
    scheme, authority, root = folders.split(spark, path)
    level, levels = spark.createDataFrame([(root,)], "folder string"), []
    while True:
        found = stored(_listed(level, scheme, authority, suffix), "listed_level")
        levels.append(found.filter("path is not null").drop("folder"))
        level = found.filter("folder is not null").select("folder")
        if level.isEmpty():
            break
        # folders of a level are spread by their hash, whoever found them
        level = level.repartition("folder")
    whole = levels[0]
    for found in levels[1:]:
        whole = whole.unionByName(found)
    return whole
