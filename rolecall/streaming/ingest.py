"""Streams into tables: each row once, whatever is replayed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolecall.sources.segments import Segments


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """The parquet table at ``path``, a folder or one file, as a stream with its own schema."""
    # a file stream takes a single file only as a pattern, here one that matches just it
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)


@contextmanager
def fitting_state(spark: SparkSession) -> Iterator[None]:
    """Start a local stream with at most two state partitions per core.

    Each state partition is a store of its own that every batch opens and commits, and
    their number is fixed when a stream first starts. A cluster keeps the session's
    setting: its cores may grow after the start.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        most = 2 * spark.sparkContext.defaultParallelism
        spark.conf.set(name, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_available(
    stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Process what is there, batch by batch, and stop. Progress lives in ``checkpoint``."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(batch)
    )
    with fitting_state(stream.sparkSession):
        return writer.start()


def append_once(
    stream: DataFrame, target: str, keys: list[str], order: list[str], checkpoint: str,
    recent: tuple[str, str] | None = None, buckets: int = 64, fan: int = 8,
) -> StreamingQuery:
    """Append the first row per key to ``target``, keys already stored left out.

    A batch is reduced to one row per key before it meets the stored keys, and reads only the
    folders its keys hash to (see ``segments``). A batch that is run again, after a lost driver or
    executor, writes the same. A target belongs to one checkpoint.

    recent: (time column, delay). Repeats that come within the delay are then dropped by the stream's
    own state, before they reach the table; of a key's rows in one batch any may be the one that stays.
    """
    if recent:
        stream = stream.withWatermark(*recent).dropDuplicatesWithinWatermark(keys)

    def store(batch: DataFrame, batch_id: int) -> None:
        Segments(batch.sparkSession, target, keys, buckets, fan).append(batch, batch_id, order)

    return run_available(stream, checkpoint, store)


def stored_rows(spark: SparkSession, target: str) -> DataFrame:
    return Segments(spark, target, []).rows()
