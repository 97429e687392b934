"""Operator 3: document fingerprints as homomorphic multiset hashes.

A paragraph (a run without line breaks, not blank) is hashed into a wide vector; a document's fingerprint is
the sum of its paragraphs' vectors, lane by lane, modulo a power of two. So the order of paragraphs does not
matter, and adding or removing a paragraph adds or subtracts its vector (``combined``): no other
paragraph is read again.

A vector has two parts. The exact lanes (16 bits each) are hashes of the whole paragraph: two documents
have equal sums only if they hold the same paragraphs as often. The likeness lanes count, modulo 2^32,
the set bits of hashes of the paragraph's pieces; a paragraph's lanes are the sums over its
pieces, so they too add up. Twice a count less the number of pieces is a sum of random signs,
and the product of two such vectors estimates how many pieces two documents share.

Pieces end where the text itself says so: after a sentence mark, and after every word whose hash is a
multiple of ``CUT``, so about every ``CUT`` words. An edit therefore changes the pieces around it only, in
lists, code and other text without marks too. Of text in ideographs or kana, each such character is a word.

Two lanes travel in one long, 32 bits apart; where fingerprints are combined, each is taken modulo 2^32, so
none runs into the other.

Defined results: a null or empty text, or one without a paragraph, has the zero fingerprint; two zero
fingerprints have likeness 1, a zero and another 0; null document ids come last in descending order;
repeated rows are fingerprinted once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolecall.functions.stage import settled

#: Hashes per paragraph, four exact lanes each; hashes per piece, 64 likeness lanes each.
EXACT, LIKE = 16, 2
#: A piece ends after a word whose hash is a multiple of this.
CUT = 8
#: Characters of scripts that set no blanks between words.
UNSPACED = r"[\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\x{20000}-\x{323AF}]"
LOW16 = 0x0000FFFF0000FFFF
LOW1 = 0x0000000100000001
LOW32 = 0xFFFFFFFF


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\r\n]+"), lambda p: F.trim(p) != "")


def pieces_of(paragraph: Column) -> Column:
    """Pieces of a paragraph: words up to one with a sentence mark at its end, or with a hash that cuts."""
    spaced = F.regexp_replace(paragraph, f"({UNSPACED})", " $1 ")
    words = F.filter(F.split(spaced, r"\s+"), lambda w: w != "")
    cuts = lambda w: (F.pmod(F.xxhash64(w, F.lit(CUT)), F.lit(CUT)) == 0) | F.substring(w, -1, 1).isin(*".!?。！？")
    marked = F.transform(words, lambda w: F.when(cuts(w), F.concat(w, F.lit("\n"))).otherwise(F.concat(w, F.lit(" "))))
    return F.filter(F.split(F.array_join(marked, ""), "\n"), lambda piece: piece != "")


def _hashes(pieces: Column, seed: int) -> Column:
    return F.transform(pieces, lambda p: F.xxhash64(p, F.lit(seed)))


def _lanes(hashes: Column, shift: int, mask: int, modulus: int | None) -> Column:
    """Sum of two lanes of each hash: its bits under ``mask`` after a shift. One text has far under 2^32 pieces."""
    def step(total: Column, h: Column) -> Column:
        added = total + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(mask))
        return added.bitwiseAND(F.lit(modulus)) if modulus else added

    return F.aggregate(hashes, F.lit(0).cast("long"), step)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, as the element of a one-row list."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column) -> Column:
    """struct(exact, like, n): packed lanes as arrays of longs, and the number of pieces."""
    def exact(found: Column, seed: int) -> Column:
        return _let(_hashes(found, seed), lambda h: F.array(*[_lanes(h, shift, LOW16, LOW16) for shift in (0, 16)]))

    def like(pieces: Column, seed: int) -> Column:
        return _let(_hashes(pieces, 1000 + seed), lambda h: F.array(*[_lanes(h, bit, LOW1, None) for bit in range(32)]))

    def whole(found: Column, pieces: Column) -> Column:
        return F.struct(
            F.concat(*[exact(found, seed) for seed in range(EXACT)]).alias("exact"),
            F.concat(*[like(pieces, seed) for seed in range(LIKE)]).alias("like"),
            F.size(pieces).cast("long").alias("n"),
        )

    return _let(
        paragraphs(text), lambda found: _let(F.flatten(F.transform(found, pieces_of)), lambda pieces: whole(found, pieces))
    )


def _hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def fingerprint_text(mark: Column) -> Column:
    """The fingerprint in hexadecimal digits."""
    lanes = F.concat(mark["exact"], mark["like"], F.array(mark["n"]))
    return F.array_join(F.transform(lanes, _hex), "")


def combined(one: Column, other: Column, sign: int = 1) -> Column:
    """Fingerprint of both texts' paragraphs together; with sign -1, of one without the other's."""
    guard = 0 if sign > 0 else 1 << 16
    def exact(a: Column, b: Column) -> Column:
        low = F.lit(guard * (1 + (1 << 32)))
        return (a + low + F.lit(sign) * b).bitwiseAND(F.lit(LOW16))

    def like(a: Column, b: Column) -> Column:
        low = a.bitwiseAND(F.lit(LOW32)) + F.lit(sign) * b.bitwiseAND(F.lit(LOW32))
        high = F.shiftrightunsigned(a, 32) + F.lit(sign) * F.shiftrightunsigned(b, 32)
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(LOW32)))

    return F.struct(
        F.zip_with(one["exact"], other["exact"], exact).alias("exact"),
        F.zip_with(one["like"], other["like"], like).alias("like"),
        (one["n"] + F.lit(sign) * other["n"]).alias("n"),
    )


def _signs(mark: Column) -> Column:
    low = F.transform(mark["like"], lambda v: (v.bitwiseAND(F.lit(LOW32)) * 2 - mark["n"]).cast("double"))
    high = F.transform(mark["like"], lambda v: (F.shiftrightunsigned(v, 32) * 2 - mark["n"]).cast("double"))
    return F.concat(low, high)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of pieces in common, 0 to 1, from two ``signed`` fingerprints.

    Equal fingerprints give 1. The estimate's standard error is about 1 / sqrt(64 * LIKE).
    """
    same = (one["exact"] == other["exact"]) & (one["like"] == other["like"])
    most = F.greatest(one["norm"], other["norm"])
    estimate = F.least(F.greatest(_dot(one["signs"], other["signs"]) / most, F.lit(0.0)), F.lit(1.0))
    return F.when(same, F.lit(1.0)).when(most > 0, estimate).otherwise(F.lit(0.0))


def signed(df: DataFrame, name: str) -> DataFrame:
    """Add to a fingerprint column its sign sums and their squared length, worked out once."""
    def with_norm(signs: Column) -> Column:
        return F.struct(
            F.col(f"{name}.exact").alias("exact"), F.col(f"{name}.like").alias("like"), F.col(f"{name}.n").alias("n"),
            signs.alias("signs"), _dot(signs, signs).alias("norm"),
        )

    return df.withColumn(name, _let(_signs(F.col(name)), with_norm))


def _place(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are below ``value``: a binary search in the expression."""
    if not bounds:
        return F.lit(0)
    array = F.array(*map(F.lit, bounds))
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(F.get(array, at + step - 1) < value, at + step).otherwise(at),
    )


def with_next(docs: DataFrame, ranges_per_partition: int = 4) -> DataFrame:
    """doc_id, text, mark (fingerprint), next_text (its first third's worth), next_mark.

    The next document is the one with the next smaller doc_id; after the smallest comes the largest.
    Documents are dealt into ranges of doc_id, and a copy of each range's first document is added to
    the range before it, so each range finds its neighbours alone. Bounds of the ranges are
    quantiles of all ids; their number follows the number of shuffle partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = ranges_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", cuts, 20 * ranges)).first()[0] or []
    # ranges count downwards, as the documents do; null ids are below all others
    place = F.when(F.col("doc_id").isNull(), F.lit(ranges)).otherwise(
        F.lit(len(set(found))) - _place(sorted(set(found)), F.col("doc_id"))
    )
    keyed = rows.withColumn("_range", place.cast("int"))
    # ties of doc_id stand in order of a hash of the text; equal rows need no order
    firsts = keyed.select("_range", F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("i"), F.xxhash64("text").alias("h")).alias("_top"))
    firsts = firsts.groupBy("_range").agg(F.max("_top").alias("_top"))
    all_ranges = Window.partitionBy()
    before = F.coalesce(F.lag("_range").over(Window.orderBy("_range")), F.max("_range").over(all_ranges))
    firsts = firsts.withColumn("_before", before)
    # one row per range: bounded by the number of ranges
    top = F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("i"), F.xxhash64("text").alias("h"))
    dealt = keyed.join(F.broadcast(firsts), "_range").withColumn("_copies", F.when(
        top == F.col("_top"), F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost")), F.struct(F.col("_before").alias("r"), F.lit(True).alias("ghost")))
    ).otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost")))))
    dealt = dealt.select("doc_id", "text", F.explode("_copies").alias("_copy")).select(
        "doc_id", "text", F.col("_copy.r").alias("_range"), F.col("_copy.ghost").alias("_ghost")
    )
    dealt = settled(dealt.repartition("_range").withColumn("mark", fingerprint(F.col("text"))), "mark")
    order = Window.partitionBy("_range").orderBy("_ghost", F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text")))
    third = F.floor(F.length("text") / 3).cast("int")
    chained = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_mark", F.lead("mark").over(order))
    return chained.filter(~F.col("_ghost")).select(
        "doc_id", "text", "mark", F.substring(F.col("next_text"), F.lit(1), third).alias("next_text"), "next_mark"
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as much of the next one's beginning."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(next_text, F.lit(1), third))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "mark", "next_mark", fingerprint(F.col("edited")).alias("edited_mark"),
    )
    rows = settled(rows, "edited_mark")
    rows = rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("mark")).alias("fingerprint"),
        fingerprint_text(F.col("edited_mark")).alias("edited_fingerprint"), "mark", "edited_mark", "next_mark",
    )
    for name in ("mark", "edited_mark", "next_mark"):
        rows = settled(signed(rows, name), name)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )
