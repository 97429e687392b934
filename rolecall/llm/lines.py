"""Operator 8: line dedup by a segment-partition edit join.

Lines are compared across all documents. Of equal lines, short ones too, the first one stays, in order of
(doc_id, line). A line of at least ``least_chars`` characters also goes if another such line within ``most`` edits
comes earlier: in shorter ones two edits make another word, so only equal ones count as repeats.

Near lines are found by segments. A line is split into most + 1 segments; a line within ``most`` edits of it
holds one of them unchanged, at nearly the same place. So each line is indexed under its segments (with
its length and the segment's number), and probes, for each length up to ``most`` shorter than its own, only
those of its substrings whose place a segment can have moved to. That is done on hashes, and only lines that meet
go on, with their texts.

Pairs that meet are compared first by the parity of their letter pairs (one edit changes at most four), then
by banded bit-parallel edit distance: for each number of errors a bit mask of the 2 * most + 1 diagonals that are
still alive, moved one character at a time. All this is the condition of a semi join, which a line leaves once, at the first
earlier line found near it: a group of many near lines gives a row for each line, not for each pair.

A few characters do not reach near-repeats of long lines. With ``word_edits``, lines of at least ``least_words``
words are also compared by the same join with words in place of characters: an edit puts in, takes out or changes
one word. Segments and pairs are then those of the words' hashes; the words themselves are compared in the end.

Everything is column expressions: no Python runs on the data.

Defined results: a null text stays null and an empty one stays empty; lines are compared without white space
at their ends; lines of white space always stay; a column called gone is replaced; null document ids come first; rows with equal id and text are one
document and keep the same lines; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.llm.common import scratch, stored

#: Line hashes and line numbers up to this many are joined by broadcast; more, by an ordinary join.
BROADCAST_ROWS = 1_000_000
WHITE = " \t\r\f"
#: What lies between the words of a line.
GAP = r"[\x20\x09-\x0D]+"


def keyed(docs: DataFrame) -> DataFrame:
    """_row (the whole row, so that no name clashes), _id, _text_hash, _text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.select(
        "_row", F.col("_row.doc_id").cast("long").alias("_id"),
        F.xxhash64(F.coalesce("_row.text", F.lit(""))).alias("_text_hash"), F.col("_row.text").alias("_text"),
    )


def occurrences(rows: DataFrame, least_chars: int, gone: str | None = None) -> DataFrame:
    """_id, _text_hash, line_no, line, n (its length), line_id of the lines long enough.

    rows: of ``keyed``; ``gone``: a column with the numbers of lines to leave out.
    """
    numbers = [gone] if gone else []
    lines = rows.select("_id", "_text_hash", *numbers, F.posexplode(F.split("_text", "\n", -1)).alias("line_no", "line"))
    if gone:
        lines = lines.filter(F.col(gone).isNull() | ~F.array_contains(gone, F.col("line_no")))
    lines = lines.withColumn("line", F.trim("line", F.lit(WHITE))).withColumn("n", F.length("line"))
    # 128 bits: two hashes
    return lines.filter(F.col("n") >= least_chars).withColumn(
        "line_id", F.struct(F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit(11)).alias("b"))
    )


def _with_numbers(rows: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    """``rows`` of ``keyed`` with each document's line numbers from a stored table, or null."""
    entries = numbers.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0]
    found = numbers.select(F.col("_id").alias("_i"), F.col("_text_hash").alias("_h"), column)
    found = F.broadcast(found) if entries <= BROADCAST_ROWS else found
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_text_hash") == F.col("_h"))
    return rows.join(found, same, "left").drop("_i", "_h")


def segments(length: int | Column, most: int) -> list[tuple[Column, Column]]:
    """(start from 0, length) of the most + 1 segments of a line; the last ones are one longer."""
    n = F.lit(length) if isinstance(length, int) else length
    parts = most + 1
    short = F.floor(n / parts).cast("int")
    longer = (n % parts).cast("int")
    found = []
    for k in range(parts):
        before = F.greatest(F.lit(k) - (F.lit(parts) - longer), F.lit(0))
        found.append(((short * k + before).cast("int"), (short + F.when(F.lit(k) >= F.lit(parts) - longer, 1).otherwise(0)).cast("int")))
    return found


def _key(line: Column, start: Column, size: Column, length: Column, k: int, words: bool) -> Column:
    cut = F.slice(line, F.greatest(start + 1, F.lit(1)), size) if words else F.substring(line, (start + 1).cast("int"), size)
    return F.xxhash64(cut, length.cast("int"), F.lit(k))


def index_keys(line: Column, n: Column, most: int, words: bool = False) -> Column:
    return F.array(*[_key(line, s, size, n, k, words) for k, (s, size) in enumerate(segments(n, most))])


def probe_keys(line: Column, n: Column, most: int, words: bool = False) -> Column:
    """Keys of the substrings that may be a segment of a line ``most`` or fewer characters (or words) shorter.

    A segment can only have moved by as many places as the edits left of it and right of it allow.
    """
    keys = []
    for shorter in range(most + 1):
        for k, (start, size) in enumerate(segments(n - shorter, most)):
            low = max(-k, shorter - (most - k))
            high = min(k, shorter + (most - k))
            for moved in range(low, high + 1):
                if shorter == 0 and moved == 0:
                    continue  # the line's own segment: lines of one length meet in the index
                at = start + moved
                inside = (at >= 0) & (at + size <= n)
                keys.append(F.when(inside, _key(line, at, size, n - shorter, k, words)))
    return F.array_compact(F.array(*keys))


def pair_parity(chars: Column) -> Column:
    """Parity of how often each pair of neighbours occurs, as two longs of hashed bits."""
    pairs = F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(1))), lambda a, b: F.xxhash64(a, b))

    def half(which: int) -> Column:
        def step(mask: Column, h: Column) -> Column:
            bit = F.pmod(h, F.lit(128)).cast("int")
            own = F.shiftright(bit, 6) == which
            return F.when(own, mask.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63))))).otherwise(mask)

        return F.aggregate(pairs, F.lit(0).cast("long"), step)

    return F.struct(half(0).alias("a"), half(1).alias("b"))


def within_edits(one: Column, other: Column, most: int) -> Column:
    """Whether two arrays of characters are within ``most`` edits of each other.

    Bit o + most of mask d: the first i = j + o characters of ``one`` can become the first j of ``other``
    with d edits. Bits outside the band of 2 * most + 1 diagonals cannot come back into reach.
    """
    band = (1 << (2 * most + 1)) - 1
    start = F.struct(*[F.lit(sum(1 << (o + most) for o in range(d + 1))).alias(f"r{d}") for d in range(most + 1)])

    def step(s: Column, j: Column) -> Column:
        char = F.get(other, j)
        match = sum(
            (F.when(F.get(one, j + o) == char, 1 << (o + most)).otherwise(0) for o in range(-most, most + 1)), F.lit(0)
        )
        return _moved(s, match, most, band)

    done = F.aggregate(F.slice(F.sequence(F.lit(0), F.size(other)), F.lit(1), F.size(other)), start, step)
    end = F.size(one) - F.size(other) + most
    inside = F.abs(F.size(one) - F.size(other)) <= most
    return inside & (F.call_function("shiftright", done[f"r{most}"], F.least(F.greatest(end, F.lit(0)), F.lit(2 * most))).bitwiseAND(F.lit(1)) == 1)


def _moved(s: Column, match: Column, most: int, band: int) -> Column:
    """All masks after one more character. Each is bound once, as the element of a one-row list."""
    def build(d: int, matched: Column, done: list[Column]) -> Column:
        if d > most:
            return F.struct(*[r.alias(f"r{i}") for i, r in enumerate(done)])
        value = s[f"r{d}"].bitwiseAND(matched)
        if d:
            before = s[f"r{d - 1}"]
            value = value.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(done[d - 1], 1))
        return F.get(F.transform(F.array(value.bitwiseAND(F.lit(band))), lambda r: build(d + 1, matched, [*done, r])), F.lit(0))

    return F.get(F.transform(F.array(match), lambda m: build(0, m, [])), F.lit(0))


def word_marks(texts: DataFrame, least_words: int) -> DataFrame:
    """line_id, line, n (its words), marks (their hashes) of the lines with words enough."""
    marked = texts.select("line_id", "line", F.transform(F.split("line", GAP), lambda w: F.xxhash64(w)).alias("marks"))
    return marked.withColumn("n", F.size("marks")).filter(F.col("n") >= least_words)


def near_pairs(texts: DataFrame, most: int, words: bool = False, lines: DataFrame | None = None, late: bool = False) -> DataFrame:
    """Pairs (one, other) of line_id of different lines within ``most`` edits, of words if ``words``; stored.

    texts: stored, distinct line_id with line and n, its length; for words, as ``word_marks`` gives them. Their lines may be
    left out if ``lines`` (stored) has line_id and line.

    ``late``: not the pairs, of which a group of near lines has as many as its square, but ``first`` of each line that comes
    after another one within ``most`` edits, once. The lines then have their place as ``first``.
    """
    with scratch(texts.sparkSession, "near_pairs") as keep:
        find = _late if late else _near_pairs
        return stored(find(texts, most, words, texts if lines is None else lines, keep), "line_near_pairs")


def _meetings(texts: DataFrame, most: int, words: bool, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(held: key and id of index entries that another line may meet, met: those of probes that meet one, ids of both)."""
    short, held_in = F.col("line_id.a"), "marks" if words else "line"
    index = texts.select(F.explode(index_keys(F.col(held_in), F.col("n"), most, words)).alias("key"), short.alias("id"))
    probe = texts.select(F.explode(probe_keys(F.col(held_in), F.col("n"), most, words)).alias("key"), short.alias("id"))
    index = keep(index, "index")
    met = keep(probe.join(index.select("key"), "key", "left_semi").distinct(), "probes")
    # repeated rows are one line: it does not meet itself
    shared = index.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("key")
    wanted = keep(shared.unionByName(met.select("key")).distinct(), "keys")
    held = keep(index.join(wanted, "key", "left_semi").distinct(), "held")
    ids = keep(held.select("id").unionByName(met.select("id")).distinct(), "ids")
    return held, met, F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _unlike(x: str, y: str) -> Column:
    """How many kinds of letter pairs are an odd number of times more in one line than in the other, at least."""
    a, b = (F.bit_count(F.col(f"{x}.pairs.{half}").bitwiseXOR(F.col(f"{y}.pairs.{half}"))) for half in "ab")
    return a + b


def _near_pairs(texts: DataFrame, most: int, words: bool, lines: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    held, met, ids = _meetings(texts, most, words, keep)
    some = texts.join(ids, F.col("line_id.a") == F.col("id"), "left_semi")
    units = F.col("marks") if words else F.split("line", "")
    some = keep(some.select("line_id", "n", pair_parity(units).alias("pairs")), "texts")
    rows = some.withColumn("id", F.col("line_id.a")).select("id", "line_id", "n", "pairs")
    left = keep(held.join(rows, "id").select("key", F.struct("line_id", "n", "pairs").alias("x")), "left")
    right = keep(met.unionByName(held).join(rows, "id").select("key", F.struct("line_id", "n", "pairs").alias("y")), "right")
    close = (
        (left["key"] == right["key"]) & (F.col("x.line_id") != F.col("y.line_id"))
        & (F.abs(F.col("x.n") - F.col("y.n")) <= most) & (_unlike("x", "y") <= 4 * most)
    )
    pairs = left.join(right, close).select(
        F.least("x.line_id", "y.line_id").alias("one"), F.greatest("x.line_id", "y.line_id").alias("other")
    ).distinct()
    pairs = keep(pairs, "pairs")
    met_lines = lines.join(ids, F.col("line_id.a") == F.col("id"), "left_semi")
    chars = met_lines.select("line_id", F.split("line", GAP if words else "").alias("chars"))
    both = pairs.join(chars.select(F.col("line_id").alias("one"), F.col("chars").alias("one_chars")), "one").join(
        chars.select(F.col("line_id").alias("other"), F.col("chars").alias("other_chars")), "other"
    )
    return both.filter(within_edits(F.col("one_chars"), F.col("other_chars"), most)).select("one", "other")


def _late(texts: DataFrame, most: int, words: bool, lines: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    held, met, ids = _meetings(texts, most, words, keep)
    cut = GAP if words else ""
    some = lines.join(ids, F.col("line_id.a") == F.col("id"), "left_semi").select(F.col("line_id.a").alias("id"), "line", "first")
    units = F.split("line", cut)
    marks = F.transform(units, lambda w: F.xxhash64(w)) if words else units
    some = keep(some.dropDuplicates(["id"]).withColumn("n", F.size(units)).withColumn("pairs", pair_parity(marks)), "texts")
    row = F.struct("first", "n", "pairs", "line")
    held = keep(held.join(some, "id").select("key", row.alias("x")), "left")
    met = keep(met.join(some, "id").select("key", row.alias("x")), "right")

    def after(rows: DataFrame, others: DataFrame) -> DataFrame:
        others = others.select(F.col("key").alias("_key"), F.col("x").alias("y"))
        # split once a pair: the one element of a list
        both = F.array(F.struct(F.split("x.line", cut).alias("a"), F.split("y.line", cut).alias("b")))
        near = (
            (F.col("key") == F.col("_key")) & (F.col("y.first") < F.col("x.first"))
            & (F.abs(F.col("x.n") - F.col("y.n")) <= most) & (_unlike("x", "y") <= 4 * most)
            & F.exists(both, lambda p: within_edits(p["a"], p["b"], most))
        )
        return rows.join(others, near, "left_semi").select("x.first")

    # a line that probes may be the earlier or the later one of the two
    return after(met.unionByName(held), held).unionByName(after(held, met)).distinct()


def dropped_lines(docs: DataFrame, most: int = 2, least_chars: int = 24, word_edits: int = 0, least_words: int = 20) -> DataFrame:
    """_id, _text_hash, gone (line numbers from 0), for documents that lose a line; stored."""
    with scratch(docs.sparkSession, "lines") as keep:
        return stored(_dropped_lines(docs, most, least_chars, word_edits, least_words, keep), "line_gone")


def _dropped_lines(
    docs: DataFrame, most: int, least_chars: int, word_edits: int, least_words: int, keep: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    place = F.struct("_id", "_text_hash", "line_no")
    rows = keyed(docs)
    found = keep(occurrences(rows, 1).select("_id", "_text_hash", "line_no", "line_id"), "places")
    first = keep(found.groupBy("line_id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    # texts of each line's first occurrence, read where they stand: no text is grouped
    repeated = first.filter("n > 1").select(F.col("line_id.a").alias("id"), "first")
    again = keep(
        found.join(repeated, (F.col("line_id.a") == F.col("id")) & (place != F.col("first")), "inner")
        .groupBy("_id", "_text_hash").agg(F.collect_set("line_no").alias("again")), "again",
    )
    left = occurrences(_with_numbers(rows, again, "again"), least_chars, "again")
    # what is left of a line is its first occurrence
    texts = keep(left.select("line_id", "line", "n", place.alias("first")), "texts")
    near = near_pairs(texts, most, late=True)
    if word_edits:
        # the lines are stored already: only their marks are written
        marks = keep(word_marks(texts, least_words).drop("line"), "words")
        near = near.unionByName(near_pairs(marks, word_edits, words=True, lines=texts, late=True))
    gone = near.select("first.*").unionByName(again.select("_id", "_text_hash", F.explode("again").alias("line_no")))
    return gone.groupBy("_id", "_text_hash").agg(F.collect_set("line_no").alias("gone"))


def without_repeats(docs: DataFrame, most: int = 2, least_chars: int = 24, word_edits: int = 0, least_words: int = 20) -> DataFrame:
    """``docs`` with repeated and near-repeated lines taken out of ``text``, and ``gone``: their numbers."""
    gone = dropped_lines(docs, most, least_chars, word_edits, least_words)
    joined = _with_numbers(keyed(docs), gone, "gone")
    lines = F.split("_text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(kept)
    columns = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c != "gone"]
    return joined.select(*columns, F.array_sort(F.coalesce("gone", F.array().cast("array<int>"))).alias("gone"))
