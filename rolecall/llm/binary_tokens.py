"""Operator 1: token ids as zstandard frames with a seek table.

A folder holds ``shards/`` and ``index/``. A shard is a row of independent zstandard frames, each
with the ids of whole documents as little-endian unsigned 32-bit integers, closed by a seek table
in the public seekable format: a skippable frame with, for each frame, its size packed, its size
unpacked and the low 32 bits of the XXH64 of its content. Any zstandard reader can unpack a shard
from front to back. ``index/`` is a Parquet table with one row per document: its shard, frame and
place, so a reader fetches and unpacks only the frames of the documents asked for.

Tasks write under names of their own and the index names the files of the attempts that counted,
so repeated or lost tasks leave nothing that a reader sees. A frame is closed once it holds
``frame_tokens`` ids; memory is bounded by that and the longest document.

Defined results: a null or empty text is one end id; null document ids come first; repeated rows
are written once each; an empty table gives an empty index and no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolecall.llm.encode import encoder

# fixed values of the public seekable format
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_WITH_CHECKSUMS = 0x80

INDEX = (
    "shard int, file string, frame int, frame_from long, frame_bytes long, frame_hash long, "
    "doc_id long, before long, at long, n_tokens long"
)


def file_system(path: str):
    """(file system, path in it) of a URI or a plain path, for use on executors."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The closing skippable frame for (packed, unpacked, checksum) of each frame."""
    body = b"".join(struct.pack("<III", *f) for f in frames)
    body += struct.pack("<IBI", len(frames), _WITH_CHECKSUMS, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int, int]]:
    """(from, packed, unpacked, checksum) of each frame of an open shard, from its last bytes."""
    size = file.size()
    count, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE or flags != _WITH_CHECKSUMS:
        raise ValueError("no seek table")
    found, at = [], 0
    for packed, unpacked, check in struct.iter_unpack("<III", file.read_at(12 * count, size - 9 - 12 * count)):
        found.append((at, packed, unpacked, check))
        at += packed
    return found


def _shard_writer(folder: str, tokenizer: str, keeps_spaces: bool, end_id: int, frame_tokens: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard
        from pyspark import TaskContext

        encode = encoder(tokenizer, keeps_spaces)
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        end = np.array([end_id], dtype="<u4").tobytes()
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        system, base = file_system(folder)
        out = None
        frames: list[tuple[int, int, int]] = []
        held: list[bytes] = []
        docs: list[tuple[int | None, int]] = []
        before = place = 0

        def close() -> list[dict]:
            nonlocal before, place
            content = b"".join(held)
            packed, check = packer.compress(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
            out.write(packed)
            rows, at = [], 0
            for doc_id, n in docs:
                rows.append({
                    "shard": shard, "file": name, "frame": len(frames), "frame_from": place,
                    "frame_bytes": len(packed), "frame_hash": check, "doc_id": doc_id,
                    "before": before, "at": at, "n_tokens": n,
                })
                at += n
                before += n
            frames.append((len(packed), len(content), check))
            place += len(packed)
            held.clear()
            docs.clear()
            return rows

        schema = pa.schema([
            ("shard", pa.int32()), ("file", pa.string()), ("frame", pa.int32()), ("frame_from", pa.int64()),
            ("frame_bytes", pa.int64()), ("frame_hash", pa.int64()), ("doc_id", pa.int64()),
            ("before", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
        ])
        size = 0
        for batch in batches:
            rows: list[dict] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                ids = encode(text.as_py()) + end
                held.append(ids)
                docs.append((doc_id, len(ids) // 4))
                size += len(ids) // 4
                if size >= frame_tokens:
                    rows += close()
                    size = 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if docs:
            yield pa.RecordBatch.from_pylist(close(), schema=schema)
        if out is not None:
            out.write(seek_table(frames))
            out.close()

    return write


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    keeps_spaces: bool = False,
    frame_tokens: int = 65_536,
    shards: int | None = None,
    level: int = 3,
) -> None:
    """Write doc_id, text as token shards in ascending doc_id order, and their index.

    shards: how many; by default the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # the hash parts rows that repeat an id; a range partition is sorted in bounded memory
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    write = _shard_writer(f"{path}/shards", tokenizer, keeps_spaces, end_id, frame_tokens, level)
    ranged.mapInArrow(write, INDEX).write.parquet(f"{path}/index")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, with ``start``: how many ids all documents before it have."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    # one row per shard, so the running sum and the broadcast are as long as the list of shards
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        index.join(F.broadcast(starts), "shard")
        .withColumn("start", F.col("_before") + F.col("before"))
        .drop("_before", "before")
    )


def read_tokens(index: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (bytes) of the documents in ``index``, any part of it.

    Only frames that hold one of them are fetched and unpacked, and each is checked against its
    checksum. Rows of a frame stand together in the index, so a frame is unpacked once.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        system, base = file_system(f"{path}/shards")
        held = opened = content = file = None
        for batch in batches:
            names, froms, sizes, checks, ats, counts = (
                batch.column(c).to_pylist()
                for c in ("file", "frame_from", "frame_bytes", "frame_hash", "at", "n_tokens")
            )
            ids = []
            for name, place, packed, check, at, n in zip(names, froms, sizes, checks, ats, counts, strict=True):
                if held != (name, place):
                    if opened != name:
                        file, opened = system.open_input_file(f"{base}/{name}"), name
                    content, held = unpacker.decompress(file.read_at(packed, place)), (name, place)
                    if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
                        raise ValueError(f"{name}: frame at {place} does not match its checksum")
                ids.append(content[4 * at : 4 * (at + n)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

    columns = ("doc_id", "start", "n_tokens", "file", "frame_from", "frame_bytes", "frame_hash", "at")
    return index.select(*columns).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
