"""Ranked picks and lookups that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# a hot key holds more rows than one of so many even parts, or of the shuffle's parts if there are more
LEAST_PARTS = 64


def top_by(df: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per key in a total order.

    A rank filtered right away lets Spark cut every map partition to ``n`` rows per key
    before the shuffle, so a hot key moves only that many rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return top_by(df, keys, order, 1)


def long_keys(df: DataFrame, keys: list[str], width: int = 10_000) -> DataFrame:
    """Keys that ``numbered`` cuts into ranges: those with more than ``width`` rows."""
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > width).select(*keys)


def numbered(df: DataFrame, keys: list[str], order: str, rank: str, width: int = 10_000, long: DataFrame | None = None) -> DataFrame:
    """Rows numbered 1, 2, ... per key by a whole-number column that is unique within the key.

    Rows without a key or an order value are left out. The rows of a key with more than ``width``
    are cut into ranges of ``width`` order values, numbered within their range, and the sizes of the
    earlier ranges are added, so no task ever sorts more than ``width`` rows of one key. Keys are
    counted right away, unless ``long`` gives the long ones (``long_keys``, others may be among them):
    where there are none, which is usual, rows move once, by their key alone, and what groups or
    joins them by key afterwards finds them together.
    """
    columns = [*keys, *(c for c in df.columns if c not in keys), rank]
    whole = df.dropna(subset=[*keys, order])
    long = long_keys(whole, keys, width) if long is None else long
    if long.isEmpty():
        at = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        return whole.withColumn(rank, at.cast("long")).select(*columns)
    # all rows of a shorter key are one range
    value = F.when(F.col("_long"), F.floor(F.col(order) / width)).otherwise(0)
    ranged = whole.join(long.withColumn("_long", F.lit(True)), keys, "left").withColumn("_range", value).drop("_long")
    sizes = whole.join(long, keys, "left_semi").groupBy(*keys, F.floor(F.col(order) / width).alias("_range")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_range").orderBy(order)
    return (
        ranged.withColumn("_at", F.row_number().over(within))
        .join(starts, [*keys, "_range"], "left")
        .withColumn(rank, (F.coalesce("_start", F.lit(0)) + F.col("_at")).cast("long"))
        .select(*columns)
    )


def even_parts(df: DataFrame) -> int:
    return max(LEAST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, on: list[str], parts: int | None = None) -> DataFrame:
    """Keys with more rows than one of ``parts`` even parts, and ``_salts``, the parts their rows fill.

    Fewer than ``parts`` keys are hot, and their salts sum to less than twice ``parts``.
    """
    parts = parts or even_parts(df)
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    filled = F.ceil(F.col("_n") * parts / total).cast("int")
    return counts.filter(F.col("_n") * parts > total).select(*on, filled.alias("_salts"))


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: list[str], spread: list[str], how: str = "left"
) -> DataFrame:
    """Join ``fact`` to a table with one row per key.

    A hot key is cut by the ``spread`` columns into as many salts as its rows fill shuffle
    parts (null keys into all of them), and only its dimension row is copied; every other key
    joins as usual. Fewer keys than shuffle parts are hot, so the hot set may be broadcast.
    """
    parts = even_parts(fact)
    hot = hot_keys(fact.select(*on), on, parts)
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    salts: Column = F.when(missing, F.lit(parts)).otherwise(F.coalesce("_salts", F.lit(1)))
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    left = (
        fact.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_salts")
    )
    right = (
        dim.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(every))
        .drop("_salts")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")
