"""Helpers that several operators share: whole-table running positions, table hand-over."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolecall.session import scratch, stored

__all__ = ["scratch", "stored", "table", "running", "bucket_count", "hash_bucket"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bucket_count(rows: int, least: int = 512) -> int:
    """Buckets that hold about the square root of all rows each: neither a bucket nor the list
    of buckets of one key is ever long. Small tables take one bucket per ``least`` rows."""
    return max(1, math.ceil(rows / max(least, math.ceil(math.sqrt(rows)))))


def hash_bucket(hex_hash: Column, buckets: int) -> Column:
    """Bucket of a hexadecimal hash; buckets follow the order of the hashes."""
    head = F.conv(F.substring(hex_hash, 1, 7), 16, 10).cast("long")
    return F.floor(head * F.lit(buckets) / F.lit(1 << 28)).cast("long")


def running(
    rows: DataFrame, keys: list[str], bucket: str, order: list, amount: Column, start: str, at: str
) -> DataFrame:
    """Each row's running total before it, within its key, in (bucket, order).

    Totals of whole buckets are summed first; rows are then summed within their bucket only. So
    a key with most of the rows is spread over its buckets. ``rows`` is read twice: pass a
    stored table. Adds ``start`` (sum of ``amount`` before the row) and ``at`` (the row's number
    in its bucket, from 0); (keys, bucket, at) names a row.
    """
    zero = F.lit(0).cast("long")
    sums = rows.groupBy(*keys, bucket).agg(F.sum(amount).cast("long").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, bucket]],
        F.coalesce(F.sum("_sum").over(earlier), zero).alias("_start"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn(at, F.row_number().over(inside).cast("long") - 1).withColumn(
        start, F.coalesce(F.sum(amount).over(before).cast("long"), zero)
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, bucket]]
    joined = numbered.join(starts, same, "inner")
    return joined.withColumn(start, F.col(start) + F.col("_start")).drop(
        "_start", *[f"_k_{k}" for k in [*keys, bucket]]
    )
