"""Session settings the jobs expect, and the shared folder they may write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # whole pages travel to Python: bound a batch by bytes as well as by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # of repeated JSON keys the last counts, as most readers have it
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int = 8, partitions: int | None = None, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rolecall")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it; a local one only without it."""
    setting = "spark.checkpoint.dir"
    folder = spark.conf.get(setting, None)
    if not folder:
        folder = spark.sparkContext.getConf().get(setting)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {setting} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="rolecall-")
        spark.conf.set(setting, folder)
    return folder


def last_of_repeated_keys(spark: SparkSession) -> None:
    """Let the JSON parser take the last of repeated keys, as most readers do, not refuse the text."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: worked out once, and safe from lost executors. ``options`` are the writer's."""
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stored`` for the tables of one step: they are removed when it ends, so what it gives must be stored before.

    A removed table cannot be read again: no plan that reads one may leave the step.
    """
    folder = work_path(spark, name)

    def keep(df: DataFrame, table: str) -> DataFrame:
        path = os.path.join(folder, f"{table}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    try:
        yield keep
    finally:
        found = spark._jvm.org.apache.hadoop.fs.Path(folder)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), "rolecall", f"{name}-{uuid.uuid4().hex}")
