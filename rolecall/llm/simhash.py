"""Operator 4: SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits, each set where over half of the text's shingle hashes have it set. Two
fingerprints that differ in at most ``most`` bits link. All links are found:

* Equal fingerprints are one class first, so exact copies never meet each other again.
* The 64 bits are dealt into m parts, bits that go together into the same part, so that parts are as
  independent of each other as can be. If part thresholds add up to most - m + 1, any two
  fingerprints within ``most`` bits agree in some part to within its threshold (-1: the part is left
  out). Thresholds, and m, are those of least estimated cost, found by dynamic programming over the
  parts; candidate counts are estimated from every fingerprint's bits.
* A fingerprint is indexed under its value in each used part and probes all values within the part's
  threshold; pairs that meet are verified on all 64 bits.
* Where a value is shared by more than ``list_most`` fingerprints, their pairs would be more than their
  one-bit variants. Those fingerprints emit themselves and their variants instead: two of them are
  within two bits exactly if they share one, and at most 65 share any. That finds the same links in
  linear work.

Components of the links over classes give each document the smallest doc_id it can reach.

Defined results: a null, empty or blank text has fingerprint zero, linked like any other; a text of
fewer words than a shingle is one shingle; repeated rows link; the component of a row is the smallest
doc_id that is not null in it, null if there is none; an empty table gives no rows; other columns are
ignored, or kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolecall.llm.common import stored
from rolecall.llm.components import components

BITS = 64
_BLOCK = 1 << 17


def simhash(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint as an unsigned number."""
    import xxhash

    found = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_hash, fp: the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([simhash(t.as_py(), words) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(marks.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(F.col("text")).alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def bit_statistics(marks: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, how many have bits i and j set), over all of them.

    Every task adds up its own 64 x 64 table; tables are summed on Spark, and 4,096 numbers come back.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(values), _BLOCK):
                part = np.ascontiguousarray(values[at : at + _BLOCK]).view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float32)
                total += bits.T.astype(np.float64) @ bits
            n += len(values)
        cells = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = marks.select("fp").mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = dict(sums.collect())
    table = np.array([found.get(i, 0) for i in range(BITS * BITS)], dtype=np.float64).reshape(BITS, BITS)
    return int(found.get(BITS * BITS, 0)), table


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` parts of nearly equal size, correlated ones together."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free = set(range(BITS))
    found = []
    for k in range(parts):
        size = (BITS - sum(map(len, found))) // (parts - k)
        first = max(free, key=lambda b: (related[b, sorted(free)].sum(), -b))
        part = [first]
        free.remove(first)
        while len(part) < size:
            nxt = max(free, key=lambda b: (related[b, part].mean(), -b))
            part.append(nxt)
            free.remove(nxt)
        found.append(sorted(part))
    return found


def near_shares(agree: np.ndarray, most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0, 1, ... ``most`` of the bits."""
    chances = np.zeros(most + 1)
    chances[0] = 1.0
    for a in agree:
        moved = np.append(0.0, chances[:-1]) * (1 - a)
        chances = chances * a + moved
    return np.cumsum(chances).tolist()


def allocate(n: int, both: np.ndarray, most: int, parts: int) -> tuple[float, list[list[int]], list[int]]:
    """(cost, parts, threshold of each) of least estimated cost for this number of parts."""
    share = np.diag(both) / max(n, 1)
    agree = share**2 + (1 - share) ** 2
    groups = grouped_bits(n, both, parts)
    budget = most - parts + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in groups:
        shares = near_shares(agree[bits], most)
        costs = {-1: 0.0}
        for t in range(most + 1):
            probes = sum(comb(len(bits), d) for d in range(t + 1))
            costs[t] = n * probes + n * n / 2 * shares[t]
        nxt: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, extra in costs.items():
                key, total = spent + t, cost + extra
                if key not in nxt or total < nxt[key][0]:
                    nxt[key] = (total, [*chosen, t])
        best = nxt
    cost, thresholds = best[budget]
    return cost, groups, thresholds


def plan(n: int, both: np.ndarray, most: int, parts: tuple[int, ...] = (1, 2, 3, 4, 5)) -> tuple[list[list[int]], list[int]]:
    _, groups, thresholds = min((allocate(n, both, most, m) for m in parts), key=lambda x: x[0])
    return groups, thresholds


def _long(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def probes(marks: DataFrame, groups: list[list[int]], thresholds: list[int]) -> DataFrame:
    """part, value, fp, probing: index rows (probing false) and probe rows of each fingerprint."""
    rows: list[Column] = []
    for k, (bits, most) in enumerate(zip(groups, thresholds, strict=True)):
        if most < 0:
            continue
        own = F.col("fp").bitwiseAND(F.lit(_long(bits)))
        flips = [_long(c) for d in range(1, most + 1) for c in combinations(bits, d)]
        rows.append(F.array(F.struct(F.lit(k).alias("part"), own.alias("value"), F.lit(False).alias("probing"))))
        if flips:
            rows.append(_probe_rows(k, own, F.array(*map(F.lit, flips))))
    return marks.select("fp", F.explode(F.concat(*rows)).alias("_p")).select("_p.part", "_p.value", "fp", "_p.probing")


def _probe_rows(part: int, own: Column, flips: Column) -> Column:
    return F.transform(
        flips, lambda f: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(f).alias("value"), F.lit(True).alias("probing"))
    )


def linked(marks: DataFrame, most: int = 2, list_most: int = 130) -> DataFrame:
    """Links (a, b) between distinct fingerprints within ``most`` (1 or 2) bits, each found at least
    as part of a path; ``marks``: a stored table with distinct column fp."""
    groups, thresholds = plan(*bit_statistics(marks), most)
    rows = stored(probes(marks, groups, thresholds), "probes")
    counts = rows.groupBy("part", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("probing")).alias("own")
    )
    counts = stored(counts.filter("n > 1 and own > 0"), "counts")
    met = stored(rows.join(counts.select("part", "value", "n"), ["part", "value"]), "met")
    # at most list_most rows a list
    lists = met.filter(F.col("n") <= list_most).groupBy("part", "value").agg(
        F.array_sort(F.collect_list(F.struct("probing", "fp"))).alias("all")
    )
    close = lists.select(F.explode(F.flatten(F.transform("all", _partners(most)))).alias("_e")).select("_e.a", "_e.b")
    dense = met.filter(F.col("n") > list_most).select("fp").distinct()
    flips = F.array(*[F.lit(x) for x in [0, *(_long((b,)) for b in range(BITS))]])
    variants = dense.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("variant"))
    # one-bit variants of a fingerprint: at most 65 fingerprints have the same
    shared = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).filter(F.size("all") > 1)
    stars = shared.select("a", F.explode("all").alias("b")).filter("a <> b")
    if most == 1:
        stars = stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 1)
    return close.unionByName(stars)


def _partners(most: int):
    def of(one: Column, at: Column) -> Column:
        later = F.filter(
            F.slice(F.col("all"), at + 2, F.size("all")),
            lambda x: ~one["probing"] & (x["fp"] != one["fp"]) & (F.bit_count(x["fp"].bitwiseXOR(one["fp"])) <= most),
        )
        return F.transform(later, lambda x: F.struct(one["fp"].alias("a"), x["fp"].alias("b")))

    return of


def _rooted(marks: DataFrame, most: int) -> DataFrame:
    """fp, first (smallest id and text hash, null ids last), root: one row per distinct fingerprint."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    classes = stored(marks.groupBy("fp").agg(first.alias("first")), "classes")
    roots = stored(components(stored(linked(classes, most), "pairs")), "roots")
    return stored(
        classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )


def near_components(docs: DataFrame, words: int = 3, most: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    marks = stored(fingerprints(docs, words), "fingerprints")
    rooted = _rooted(marks, most)
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("first")), "smallest")
    # stored sides, so that a fingerprint or component with much of the table can be split
    by_mark = rooted.join(smallest.select("root", F.col("first.id").alias("component_id")), "root")
    by_mark = stored(by_mark.select("fp", "component_id"), "by_mark")
    return marks.join(by_mark, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 3, most: int = 2) -> DataFrame:
    """``docs`` with only one document of each component: the one with the smallest doc_id."""
    marks = stored(fingerprints(docs, words), "fingerprints")
    return only(docs, stored(_rooted(marks, most).groupBy("root").agg(F.min("first").alias("first")), "kept"))


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names: first (with id and text hash), one row each."""
    kept = kept.select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (_text_hash(F.col("_row.text")) == F.col("_hash"))
    joined = rows.join(kept, same)
    # rows that repeat both id and text: one of them
    at = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.xxhash64("_row.text")))
    return joined.withColumn("_at", at).filter("_at = 1").select(*[F.col(f"_row.`{c}`") for c in docs.columns])
