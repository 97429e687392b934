"""A store of posting documents in parts that split as they grow, under a manifest.

A part holds the keys whose 32-bit hash begins with its ``depth`` bits ``prefix``; parts never overlap and together cover
every hash. A write reads and replaces only the parts its own keys fall in. A part that would exceed ``part_bytes`` is
written as as many parts as its size needs at once, so the cost of a write follows what it touches, not the store.

Replaced parts are written into a folder of the new version, and the manifest that names them is put in place last, by a
rename. A write that dies leaves the version before it as it was, and can simply be run again. The folders of a version
are removed by the second write after it has lost them, so whoever reads the version before can go on reading.

One writer at a time. The driver holds the manifest, one short entry per part, never keys or documents. A key's own rows
are not split: a key whose rows exceed ``part_bytes`` has a part of that size.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecall.session import stored
from rolecall.sources import folders, readers
from rolecall.sources.writers import document_line, without_keys, write_lines

BITS = 32
PART = "_part"
#: A list of this many parts is joined by broadcast; a longer one, by an ordinary join.
BROADCAST_PARTS = 100_000


def key_bits(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


def needed_bits(size: int, most: int) -> int:
    """How often a part of this size must be halved."""
    return max(0, -(-size // most) - 1).bit_length()


class PostingStore:
    def __init__(self, spark: SparkSession, target: str, part_bytes: int = 256 << 20):
        self.spark, self.target, self.part_bytes = spark, target.rstrip("/"), part_bytes

    # --- versions ----------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        found = folders.names(self.spark, f"{self.target}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in found if n.removesuffix(".json").isdigit())

    def parts(self, version: int | None = None) -> list[dict]:
        """depth, prefix and version (its folder's, null for a part without rows) of a version's parts; by default the newest."""
        found = self.versions()
        if version is None and not found:
            return [{"depth": 0, "prefix": 0, "version": None}]
        return json.loads(folders.read_text(self.spark, f"{self.target}/manifest/{version or found[-1]}.json"))

    def path(self, part: dict) -> str:
        return f"{self.folder(part['version'])}/{PART}={part['depth']}-{part['prefix']}"

    def folder(self, version: int) -> str:
        return f"{self.target}/parts/{version}"

    def read(self, version: int | None = None) -> DataFrame:
        """Whole documents, as ``readers.read_postings`` gives them."""
        paths = [self.path(p) for p in self.parts(version) if p["version"] is not None]
        if not paths:
            raise ValueError(f"no posting was stored at {self.target}")
        with folders.few_listing_tasks(self.spark):
            return readers.read_postings(self.spark, paths)

    # --- writing -----------------------------------------------------------------------------------------------------

    def _placed(self, rows: DataFrame, parts: list[tuple]) -> DataFrame:
        """``rows`` with depth, prefix and bits (how often their part is halved) of the part their hash ``_h`` lies in."""
        depths = sorted({p[0] for p in parts})  # at most 33
        at = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.shiftright("_h", BITS - d).alias("p")) for d in depths]))
        known = self.spark.createDataFrame(parts, "depth int, prefix long, bits int")
        known = F.broadcast(known) if len(parts) <= BROADCAST_PARTS else known
        same = (F.col("_at.d") == F.col("depth")) & (F.col("_at.p") == F.col("prefix"))
        return rows.withColumn("_at", at).join(known, same).drop("_at")

    def write(self, postings: DataFrame) -> int:
        """Add or replace postings by key (null is one key); all other lines stay as they were. Returns the new version."""
        version = (self.versions() or [0])[-1] + 1
        parts = self.parts()
        line = document_line(postings.columns)
        fresh = stored(postings.select("job_key", line.alias("value"), key_bits(F.col("job_key")).alias("_h")), "store_new")
        of_parts = [(p["depth"], p["prefix"], 0) for p in parts]
        touched = {tuple(r) for r in self._placed(fresh, of_parts).select("depth", "prefix").distinct().collect()}  # at most all parts
        hit = [p for p in parts if (p["depth"], p["prefix"]) in touched]
        merged = fresh.select("value", "_h")
        paths = [self.path(p) for p in hit if p["version"] is not None]
        if paths:
            with folders.few_listing_tasks(self.spark):
                old = self.spark.read.schema("value string").text(paths)
            kept = without_keys(old.withColumn("job_key", F.get_json_object("value", "$.job_key")), fresh)
            merged = stored(kept.select("value", key_bits(F.col("job_key")).alias("_h")).unionByName(merged), "store_merged")
        placed = self._placed(merged, [(d, p, 0) for d, p in touched]) if touched else None
        news = []
        if placed is not None:
            sizes = placed.groupBy("depth", "prefix").agg(F.sum(F.octet_length("value") + 1).alias("size")).collect()
            # what a part still lacks to the deepest level is all that it can be halved
            halved = {(r["depth"], r["prefix"]): min(needed_bits(r["size"], self.part_bytes), BITS - r["depth"]) for r in sizes}
            cut = self._placed(merged, [(d, p, halved[d, p]) for d, p in touched])
            deeper = F.col("depth") + F.col("bits")
            name = F.concat_ws("-", deeper.cast("string"), F.call_function("shiftright", F.col("_h"), F.lit(BITS) - deeper).cast("string"))
            folder = self.folder(version)
            # rows of a part together, in tasks of even size
            write_lines(cut.select("value", name.alias(PART)).hint("rebalance", F.col(PART)), folder, PART)
            written = set(folders.names(self.spark, folder))
            for depth, prefix in sorted(touched):
                bits = halved[depth, prefix]
                for child in range(prefix << bits, (prefix + 1) << bits):
                    held = f"{PART}={depth + bits}-{child}" in written
                    news.append({"depth": depth + bits, "prefix": child, "version": version if held else None})
        left = [p for p in parts if (p["depth"], p["prefix"]) not in touched]
        folders.write_text(self.spark, f"{self.target}/manifest/{version}.json", json.dumps(left + news))
        self._clean()
        return version

    def _clean(self) -> None:
        """Remove the manifests before the newest two, and the parts that only those name."""
        *gone, before, _ = [None, None, *self.versions()]
        for v in [v for v in gone if v is not None]:
            left = [*self.parts(before), *self.parts()]
            kept, versions = {self.path(p) for p in left}, {p["version"] for p in left}
            # a version that no part is left of goes as one folder
            named = {self.path(p) if p["version"] in versions else self.folder(p["version"]) for p in self.parts(v) if p["version"] is not None}
            for path in sorted(named - kept):
                folders.remove(self.spark, path)
            folders.remove(self.spark, f"{self.target}/manifest/{v}.json")
