"""Operator 10: harmonic packing of documents into fixed-length sequences.

Lengths fall into reciprocal-capacity classes: class k takes k documents (or pieces) a sequence. A
document is cut into pieces of the classes' own lengths, the longest that fits first: floor(C/k)
tokens for k up to ``classes``, and below that every length of its own. So all pieces of a class are
equally long, each sequence of a class takes exactly floor(C/length) of them, and a piece's sequence
and place follow from its number within its class alone: no worker needs to know what another one
packs. Numbers come from two-level running counts, so a class with most of the pieces is spread.

Each class leaves at most one unfilled sequence. Their pieces, fewer in all than the sum of the
classes' counts whatever the input (about 10,000 at 2,048), are packed together by first fit, longest
first, in one task: a bound that does not grow with the data.

Defined results: a null or empty text is its end id alone; repeated rows are packed once each; null
document ids are packed as null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolecall.llm.common import bucket_count, running, stored
from rolecall.llm.encode import encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def class_lengths(capacity: int, classes: int = 32) -> list[int]:
    """The lengths pieces may have, longest first."""
    top = {capacity // k for k in range(1, classes + 1)}
    return sorted(top | set(range(1, min(top))), reverse=True)


def cuts(n: int, lengths: list[int]) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens."""
    found = [lengths[0]] * (n // lengths[0])
    rest = n % lengths[0]
    for length in lengths[1:]:
        if length <= rest:
            found += [length] * (rest // length)
            rest %= length
    return found


#: Ids held before a batch of pieces is handed over, in bytes.
_HELD = 8 << 20


def _cutter(tokenizer: str, keeps_spaces: bool, end_id: int, capacity: int, classes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_spaces)
        lengths = class_lengths(capacity, classes)
        end = np.array([end_id], dtype="<u4").tobytes()
        known: dict[int, np.ndarray] = {}

        def pieces_of(total: int) -> np.ndarray:
            rest = total % capacity
            if rest not in known:
                known[rest] = np.array(cuts(rest, lengths), dtype=np.int64)
            whole = total // capacity
            return np.concatenate([np.full(whole, capacity, dtype=np.int64), known[rest]]) if whole else known[rest]

        def rows(doc_ids: pa.Array, found: list[bytes]) -> pa.RecordBatch:
            totals = np.array([len(x) // 4 for x in found], dtype=np.int64)
            parts = [pieces_of(n) for n in totals.tolist()]
            counts = np.array([len(p) for p in parts], dtype=np.int64)
            sizes = np.concatenate(parts)
            ends = np.cumsum(sizes)
            before = np.repeat(np.cumsum(totals) - totals, counts)
            offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(found))])
            columns = [
                doc_ids.take(pa.array(np.repeat(np.arange(len(found)), counts))), pa.array(ends - sizes - before),
                pa.array(sizes), pa.array(np.repeat(totals, counts)), ids,
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "ids"])

        for batch in batches:
            first, held, found = 0, 0, []
            for ids in encode.many(text.as_py() for text in batch.column(1)):
                found.append(ids + end)
                held += len(found[-1])
                if held >= _HELD:
                    yield rows(batch.column(0).slice(first, len(found)), found)
                    first, held, found = first + len(found), 0, []
            if found:
                yield rows(batch.column(0).slice(first, len(found)), found)

    return cut


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, keeps_spaces: bool = True,
    classes: int = 32,
) -> DataFrame:
    """Pieces of doc_id, text: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_cutter(tokenizer, keeps_spaces, end_id, capacity, classes), PIECES)


def _first_fit(capacity: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_class_at"], ascending=[False, True], kind="stable")
        free: list[int] = []
        first: dict[int, int] = {}
        bins, offsets = [], []
        for length in rows["length"]:
            at = first.get(length, 0)  # what was too full for this length stays so
            while at < len(free) and free[at] < length:
                at += 1
            if at == len(free):
                free.append(capacity)
            first[length] = at
            bins.append(at)
            offsets.append(capacity - free[at])
            free[at] -= length
        return pd.DataFrame({
            "length": rows["length"], "_class_at": rows["_class_at"], "_bin": bins, "_offset": offsets
        })

    return fit


def place_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces (see ``cut_documents``) with ids_crc32."""
    rows = pieces.count()
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(bucket_count(rows))).cast("long")
    slim = pieces.withColumn("_bucket", bucket)
    numbered = running(
        slim, ["length"], "_bucket", [F.col("doc_id"), F.col("start"), F.col("ids_crc32"), F.col("doc_tokens")],
        F.lit(1), "_class_at", "_at",
    ).drop("_at", "_bucket")
    per: Column = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    # a row per length that a piece can have: at most `capacity`
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("_n")).withColumn("_full", F.floor(F.col("_n") / per))
    before = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        "length", "_n", "_full", F.coalesce(F.sum("_full").over(before), F.lit(0)).alias("_first"),
        F.sum("_full").over(Window.partitionBy()).alias("_all_full"),
    )
    # pieces beyond a class's full sequences, by number: fewer than `per` of each length
    left = firsts.filter(F.col("_n") > F.col("_full") * per).select(
        "length", F.explode(F.sequence(F.col("_full") * per, F.col("_n") - 1)).alias("_class_at")
    )
    fitted = left.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(
        _first_fit(capacity), "length long, _class_at long, _bin long, _offset long"
    )
    placed = numbered.join(F.broadcast(firsts), "length")
    whole = F.col("_class_at") < F.col("_full") * per
    placed = placed.join(F.broadcast(fitted), ["length", "_class_at"], "left")
    return placed.withColumn(
        "sequence_id",
        F.when(whole, F.col("_first") + F.floor(F.col("_class_at") / per)).otherwise(F.col("_all_full") + F.col("_bin")).cast("long"),
    ).withColumn(
        "offset", F.when(whole, F.col("_class_at") % per * F.col("length")).otherwise(F.col("_offset")).cast("long")
    ).drop("_class_at", "_n", "_full", "_first", "_all_full", "_bin", "_offset")


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, keeps_spaces: bool = True,
    classes: int = 32,
) -> DataFrame:
    """Pieces with their place: doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset.

    Pieces are encoded once and kept with their ids in the shared folder; ids_crc32 is that of the ids read back. A sequence is its pieces in order of
    ``offset``, padded to ``capacity``; see ``sequences``.
    """
    pieces = stored(cut_documents(docs, tokenizer, end_id, capacity, keeps_spaces, classes), "pieces")
    read = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "ids")
    return place_pieces(read, capacity)


def sequences(placed: DataFrame, capacity: int, pad_id: int) -> DataFrame:
    """sequence_id, ids (bytes): whole sequences, padded to ``capacity`` unless their length is a
    power of two. A group is one sequence, so never longer than ``capacity`` tokens."""
    pad = np.array([pad_id], dtype="<u4").tobytes()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        ids = b"".join(rows.sort_values("offset")["ids"])
        n = len(ids) // 4
        if n & (n - 1):
            ids += pad * (capacity - n)
        return pd.DataFrame({"sequence_id": rows["sequence_id"].iloc[:1], "ids": [ids]})

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        build, "sequence_id long, ids binary"
    )
