"""Operator 2: mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Each source's documents, in hashed order, make one line of words; the line is cut
into blocks of equally many words. The mix is a row of slots, one block each. Slot k stands at the
golden-ratio point k * phi mod 1; the points are mapped through the sources' cumulative shares, so
any stretch of slots holds each source close to its share. The slots of a source are ranked, and its
r-th slot takes its r-th block; after the last block the line starts again.

A source's quota is its target in whole words: the slot that would pass it is cut short, slots ranked
beyond it stay empty, and slots that the schedule still owes (a few per source) follow at its end.

Points are whole numbers modulo 2^31, so the schedule is exact and the same in every run. Ranks and
line positions come from two-level running counts: a source with most of the rows is spread.

Defined results: a null, empty or blank text has size 0 and is never taken; null sources are one
source, the last; null document ids and repeated rows are documents like any other; an empty table, or
one without words, gives an empty schedule; other columns are ignored. Tables with one row per source
(shares, quotas) are ordered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolecall.llm.common import bucket_count, hash_bucket, running, stored

WORD = r"[^\x20\x09-\x0D]+"
TOP = 1 << 31
#: The odd number nearest to 2^31 divided by the golden ratio.
STEP = 1_327_217_885
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _source_key(source: Column) -> Column:
    text = source.cast("string")
    return F.when(text.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), text))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_hash, the source as a key that is never null, a hash that orders its line."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"),
        _text_hash(F.col("text")).alias("text_hash"), _source_key(F.col("source")).alias("source_key"),
    ).withColumn(
        "line_hash", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.col("size")))
    )


def source_targets(rows: DataFrame, repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source_key, source_size, target, quota: one row per source.

    Weights repeat over the sources in order of their key. A target is the source's share of all
    words by weight, at most ``repeats`` times its size; what is cut off is shared out again by
    weight among the others until no target is above. Ordered by size per weight, the sources that
    are cut come first, so one pass in that order finds them all.
    """
    sizes = rows.groupBy("source_key").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy("source_key")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    ranked = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    by_need = Window.orderBy(F.col("_cap") / F.col("_w"), "source_key").rowsBetween(Window.unboundedPreceding, -1)

    def rest(total: str, spent: str) -> Column:
        return F.sum(total).over(everything) - F.coalesce(F.sum(spent).over(by_need), F.lit(0))

    left = ranked.withColumn("_words", rest("source_size", "_cap")).withColumn("_weights", rest("_w", "_w"))
    wide = "decimal(38,0)"
    cut = F.col("_cap").cast(wide) * F.col("_weights") <= F.col("_words").cast(wide) * F.col("_w")
    cut_rows = left.withColumn("_cut", cut)
    free_words = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("_cut"), F.col("_cap"))).over(everything), F.lit(0)
    )
    free_weights = F.sum(F.when(~F.col("_cut"), F.col("_w"))).over(everything)
    shared = free_words * F.col("_w") / free_weights
    target = F.when(F.col("_cut"), F.col("_cap").cast("double")).otherwise(shared)
    return cut_rows.withColumn("target", target).select(
        "source_key", "source_size", "target", F.floor(F.col("target") + 0.5).cast("long").alias("quota")
    )


def with_blocks(targets: DataFrame, block: int) -> DataFrame:
    """How many blocks a source's line has, and how many slots its quota needs."""
    def blocks(words: Column) -> Column:
        return F.ceil(words / F.lit(block)).cast("long")

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0).cast("long")
    return targets.withColumn("blocks", blocks(F.col("source_size"))).withColumn(
        "slots", whole * F.col("blocks") + blocks(F.col("quota") - whole * F.col("source_size"))
    )


def scheduled(sources: DataFrame, block: int) -> DataFrame:
    """The schedule: slot, source_key, pass, block, words.

    sources: the stored result of ``with_blocks``.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    upto = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, 0)
    part = TOP // CELLS

    def point(slots: Column) -> Column:
        return F.floor(slots.cast("decimal(38,0)") * TOP / F.lit(max(total, 1))).cast("long")

    spans = sources.withColumn("_to", F.sum("slots").over(upto)).select(
        "*", point(F.col("_to") - F.col("slots")).alias("_lo"), point(F.col("_to")).alias("_hi")
    ).filter(F.col("_hi") > F.col("_lo"))
    spans = spans.withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("_lo") / part), F.floor((F.col("_hi") - 1) / part)))
    )
    width = max(1024, math.ceil(math.sqrt(total)))
    slots = spark.range(total).select(F.col("id").alias("slot")).withColumn(
        "_u", (F.col("slot") % TOP) * F.lit(STEP) % TOP
    ).withColumn("_cell", F.floor(F.col("_u") / part))
    # cells cut the range of points, so a cell meets only the sources whose spans touch it
    inside = (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))
    drawn = slots.join(spans.select("source_key", "_cell", "_lo", "_hi"), "_cell").filter(inside).select(
        "slot", "source_key", F.floor(F.col("slot") / width).cast("long").alias("_range")
    )
    drawn = stored(drawn, "slots")
    ranked = running(drawn, ["source_key"], "_range", [F.col("slot")], F.lit(1), "rank", "_at")
    counts = drawn.groupBy("source_key").agg(F.count(F.lit(1)).alias("_n"))
    lacking = sources.join(counts, "source_key", "left").select(
        "source_key", "slots", F.coalesce("_n", F.lit(0)).alias("_n")
    ).withColumn("_owed", F.greatest(F.col("slots") - F.col("_n"), F.lit(0)))
    earlier = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)
    owed = lacking.withColumn("_before", F.coalesce(F.sum("_owed").over(earlier), F.lit(0))).filter("_owed > 0")
    owed = owed.select(
        "source_key", "_n", "_before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_owed") - 1)).alias("_i")
    ).select(
        (F.lit(total) + F.col("_before") + F.col("_i")).alias("slot"), "source_key", (F.col("_n") + F.col("_i")).alias("rank")
    )
    every = ranked.select("slot", "source_key", "rank").unionByName(owed)
    # rows of a source are many, sources few: the smaller side is a row per source
    placed = every.join(sources, "source_key").filter(F.col("rank") < F.col("slots"))
    placed = placed.withColumn("pass", F.floor(F.col("rank") / F.col("blocks")).cast("long")).withColumn(
        "block", F.col("rank") % F.col("blocks")
    )
    begin = F.col("block") * block
    end = F.least(begin + block, F.col("source_size"), F.col("quota") - F.col("pass") * F.col("source_size"))
    return placed.select("slot", "source_key", "pass", "block", (end - begin).alias("words"))


def mix(
    docs: DataFrame, block_words: int = 4096, least_slots: int = 65_536, repeats: int = 3,
    weights: tuple[int, ...] = (1, 2, 3),
) -> tuple[DataFrame, DataFrame]:
    """(documents on their lines, the mix).

    Documents: doc_id, size, source_key, source_size, target, line_bucket, line_at, line_from.
    The mix, one row per document and slot: slot, pass, word_from, word_to (of the document) and the
    document's line_bucket, line_at. Blocks hold ``block_words`` words, fewer only where the mix
    would have under ``least_slots`` slots.
    """
    rows = stored(sized(docs), "sizes")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    block = max(1, min(block_words, (total or 0) // least_slots))
    rows = rows.withColumn("line_bucket", hash_bucket(F.col("line_hash"), bucket_count(n)))
    sources = stored(with_blocks(source_targets(rows, repeats, weights), block), "sources")
    order = [F.col("line_hash"), F.col("doc_id"), F.col("size"), F.col("text_hash")]
    lines = running(rows, ["source_key"], "line_bucket", order, F.col("size"), "line_from", "line_at")
    lines = stored(
        lines.join(sources.select("source_key", "source_size", "target"), "source_key").drop("line_hash"), "lines"
    )
    parts = lines.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("line_from") / block), F.floor((F.col("line_from") + F.col("size") - 1) / block)))
    )
    begin = F.col("block") * block
    taken = parts.join(scheduled(sources, block), ["source_key", "block"]).select(
        "slot", "pass", "source_key", "line_bucket", "line_at",
        (F.greatest(F.col("line_from"), begin) - F.col("line_from")).alias("word_from"),
        (F.least(F.col("line_from") + F.col("size"), begin + F.col("words")) - F.col("line_from")).alias("word_to"),
    ).filter(F.col("word_to") > F.col("word_from"))
    return lines, taken


def taken_words(lines: DataFrame, taken: DataFrame) -> DataFrame:
    """The documents with ``taken``: the words of them that the mix holds, repeats counted."""
    key = ["source_key", "line_bucket", "line_at"]
    sums = taken.groupBy(*key).agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    return lines.join(sums, key, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each as often as it is taken whole, and once more up to where a quota cuts it.

    A quota cuts one document of its source at most, so every source has just the words the mix takes of it.
    Of a document taken in part, ``text`` ends with the last word taken; all other columns stay as they are.
    """
    taken = taken_words(*mix(docs, **options)).filter("taken > 0")
    key = ["doc_id", "text_hash", "source_key"]
    times = taken.groupBy(*key).agg(
        F.sum(F.floor(F.col("taken") / F.col("size"))).cast("long").alias("_times"),
        F.sum(F.col("taken") % F.col("size")).alias("_rest"), F.count(F.lit(1)).alias("_rows"),
    )
    times = stored(times, "times").withColumnsRenamed({k: f"_{k}" for k in key})
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = [
        F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_doc_id")), _text_hash(F.col("_row.text")) == F.col("_text_hash"),
        _source_key(F.col("_row.source")) == F.col("_source_key"),
    ]
    joined = rows.join(times, same)
    # rows that repeat id, text and source share their times evenly; the first of them has the part
    at = F.row_number().over(Window.partitionBy("_doc_id", "_text_hash", "_source_key").orderBy(F.xxhash64("_row.text")))
    own = F.floor(F.col("_times") / F.col("_rows")) + F.when(at <= F.col("_times") % F.col("_rows"), 1).otherwise(0)
    own_times = joined.withColumn("_own", own.cast("int")).withColumn("_part", ((at == 1) & (F.col("_rest") > 0)).cast("int"))
    copies = own_times.filter("_own + _part > 0").select(
        "_row", "_own", "_rest", F.explode(F.sequence(F.lit(1), F.col("_own") + F.col("_part"))).alias("_copy")
    )
    cut = F.when(F.col("_copy") > F.col("_own"), first_words(F.col("_row.text"), F.col("_rest"))).otherwise(F.col("_row.text"))
    return copies.select(*[cut.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
