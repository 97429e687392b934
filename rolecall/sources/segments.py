"""A table that grows batch by batch, each key once, under a manifest.

Rows lie in segments, each cut into folders by a hash of the key. A manifest per batch names the live segments and is put
in place last, by a rename: whoever reads sees a whole batch or nothing of it, and a batch that is run again after a lost
driver starts from the manifest before its own.

A batch reads only the folders its own keys hash to. Segments of a level are merged into one of the next level once there
are more than ``fan`` of them, so after n batches about fan * log(n) segments are live, however many batches there were;
what no manifest in use names is removed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolecall.operators.skew import first_by
from rolecall.sources import folders

BUCKET = "_bucket"


class Segments:
    """``keys``: columns that name a row; null is a value like others. ``buckets`` and ``fan`` stay as they are for a table's life."""

    def __init__(self, spark: SparkSession, target: str, keys: list[str], buckets: int = 64, fan: int = 8):
        self.spark, self.target, self.keys, self.buckets, self.fan = spark, target.rstrip("/"), keys, buckets, fan

    # --- manifests ---------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        found = folders.names(self.spark, f"{self.target}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[:-5].lstrip("-").isdigit())

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest of an earlier batch."""
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return {"schema": None, "segments": []}
        return json.loads(folders.read_text(self.spark, f"{self.target}/manifest/{found[-1]}.json"))

    # --- reading -----------------------------------------------------------------------------------------------------

    def paths(self, segments: list[dict], buckets: set[int] | None = None) -> list[str]:
        return [
            f"{self.target}/segments/{s['name']}/{BUCKET}={b}" for s in segments for b in s["buckets"] if buckets is None or b in buckets
        ]

    def _read(self, paths: list[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """All rows of the newest whole batch and those before it."""
        found = self.manifest()
        if found["schema"] is None:
            raise ValueError(f"no batch was stored at {self.target}")
        return self._read(self.paths(found["segments"]), StructType.fromJson(found["schema"]))

    # --- writing -----------------------------------------------------------------------------------------------------

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _written(self, rows: DataFrame, name: str, level: int, held: list[int] | None = None) -> dict:
        """Write a segment; ``held``: its folders, where they are known."""
        path = f"{self.target}/segments/{name}"
        # rows of a folder together, in tasks of even size: few files, and a large folder is still split
        rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy(BUCKET).parquet(path)
        if held is None:
            prefix = f"{BUCKET}="
            held = sorted(int(n.removeprefix(prefix)) for n in folders.names(self.spark, path) if n.startswith(prefix))
        return {"name": name, "level": level, "buckets": held}

    def append(self, batch: DataFrame, batch_id: int, order: list) -> None:
        """Add the first row of each key that is not stored yet. Running a batch again gives the same table."""
        earlier = self.manifest(before=batch_id)
        live = earlier["segments"]
        schema = batch.schema
        work = f"{self.target}/work/{batch_id}"
        # one row per key before anything meets the table, so a hot key costs one row
        self._bucketed(first_by(batch, self.keys, order)).write.mode("overwrite").parquet(work)
        fresh = self.spark.read.parquet(work)
        touched = {r[0] for r in fresh.select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        known = self._read(self.paths(live, touched), schema).select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        new = self._written(fresh.join(known, same, "left_anti"), f"b{batch_id}", 0)
        live = [*live, new] if new["buckets"] else live
        live = self._merged(live, batch_id, schema)
        text = json.dumps({"schema": json.loads(schema.json()), "segments": live})
        folders.write_text(self.spark, f"{self.target}/manifest/{batch_id}.json", text)
        self._clean(batch_id)

    def _merged(self, live: list[dict], batch_id: int, schema: StructType) -> list[dict]:
        level = 0
        while any(s["level"] >= level for s in live):
            of_level = [s for s in live if s["level"] == level]
            if len(of_level) > self.fan:
                rows = self._bucketed(self._read(self.paths(of_level), schema))
                held = sorted({b for s in of_level for b in s["buckets"]})
                merged = self._written(rows, f"m{batch_id}-{level + 1}", level + 1, held)
                live = [merged, *(s for s in live if s["level"] != level)]
            level += 1
        return live

    def _clean(self, batch_id: int) -> None:
        """Remove what neither this batch's manifest nor the one before it names: the latter is where a replay starts."""
        versions = [v for v in self.versions() if v <= batch_id]
        kept = versions[-2:]
        named = set()
        for v in kept:
            text = folders.read_text(self.spark, f"{self.target}/manifest/{v}.json")
            named |= {s["name"] for s in json.loads(text)["segments"]}
        for v in versions[:-2]:
            folders.remove(self.spark, f"{self.target}/manifest/{v}.json")
        for name in folders.names(self.spark, f"{self.target}/segments"):
            if name not in named:
                folders.remove(self.spark, f"{self.target}/segments/{name}")
        for name in folders.names(self.spark, f"{self.target}/work"):
            folders.remove(self.spark, f"{self.target}/work/{name}")
