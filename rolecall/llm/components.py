"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecall.llm.common import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    total = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))
    n, mark = edges.agg(F.count(F.lit(1)), total).first()
    return n, mark or 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b, any type with an order); root is the
    component's smallest node.

    Each round turns every node's larger neighbours to its smallest neighbour, then its smaller
    neighbours too; links shrink to one star per component in about log(size) rounds. Both sides of
    every join are stored tables, so a node with very many links can be split, and each round's
    table ends the lineage of the one before.
    """
    edges = stored(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    before = _mark(edges)
    while before[0]:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mins = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "mins")
        large = stored(
            both.filter("b > a").join(mins, "a").select(F.col("m").alias("a"), "b").distinct(), "links"
        )
        mins = stored(large.groupBy("b").agg(F.min("a").alias("m")), "mins")
        turned = large.join(mins, "b").select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("_e")
        )
        edges = stored(turned.select("_e.a", "_e.b").filter("a <> b").distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    # now every edge runs from a component's smallest node to another one
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
