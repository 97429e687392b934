"""Operator 5: near-duplicate vectors by E8 lattice hashing.

A vector is brought to length one and projected, in each of ``tables`` tables, by random directions to
eight dimensions; there it is decoded to the nearest point of the E8 lattice, its cell. It is indexed
under its cell and probes the ``neighbours`` cells nearest to it among the 240 around its own. Vectors
with equal labels that meet are verified by their cosine in double precision.

Nothing is written per pair. Meeting vectors are compared block by block in matrix products, and a block
gives back how many links each vector has in it and the links of a spanning forest. A pair that meets in
several tables or cells is counted in the first only, which both vectors' cells tell by themselves.
Buckets of more than ``block`` rows are cut into blocks, and every two blocks are one task's group, so
large buckets are spread and nothing is left out; small buckets share groups. Equal vectors are one vector with a weight first.

Measured on pairs at cosine 0.982 the default tables and neighbours miss about one pair in 700; pairs that
are closer, or linked through others, less. Every link given is exact.

Defined results: rows with a null label, or a vector that is null, empty, zero or holds null, infinite or
not-a-number values, link with nothing; vectors of other lengths than each other never link; equal vectors
with equal labels link; a component's id is its smallest vec_id that is not null; rows with a null vec_id
are not kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecall.llm.common import stored
from rolecall.llm.components import components

#: Hot buckets up to this many are joined by broadcast; more than that, by an ordinary join.
BROADCAST_ROWS = 100_000
#: Small buckets are compared in groups of about this many rows.
PACK_ROWS = 4096


def _round_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates that add up to an even number."""
    near = np.rint(x)
    rest = x - near
    worst = np.abs(rest).argmax(axis=1)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    near[odd, worst[odd]] += np.where(rest[odd, worst[odd]] >= 0, 1, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: whole coordinates, or all shifted by a half, whichever is nearer."""
    whole, half = _round_d8(x), _round_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a cell to those around it."""
    found = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            step = [0.0] * 8
            step[i], step[j] = s, t
            found.append(step)
    found += [list(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


def cells(unit: np.ndarray, table: int, neighbours: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, cells probed) of unit vectors in a table, as doubled whole coordinates."""
    directions = np.random.default_rng([seed, table]).normal(size=(unit.shape[1], 8)) * scale
    points = unit @ directions
    own = decode_e8(points)
    steps = shortest_e8()
    order = np.argsort(-((points - own) @ steps.T), axis=1, kind="stable")[:, :neighbours]
    return (2 * own).astype(np.int64), (2 * (own[:, None, :] + steps[order])).astype(np.int64)


def _keys(points: np.ndarray, table: int, labels: list[int]) -> np.ndarray:
    """A hash of label, table and cell for each point; equal cells have equal keys."""
    flat = points.reshape(-1, 8)
    each = flat.shape[0] // max(len(labels), 1)
    out = np.empty(flat.shape[0], dtype=np.int64)
    for i, point in enumerate(flat):
        head = f"{labels[i // each]}|{table}|".encode()
        out[i] = int.from_bytes(hashlib.blake2b(head + point.tobytes(), digest_size=8).digest(), "little", signed=True)
    return out.reshape(points.shape[:-1])


def usable_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label, sign (a hash of label and vector; null where nothing links), vector (bytes)."""
    kind = "<f4" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, vectors = [], []
            for label, values in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
                sign = vector = None
                if label is not None and values.is_valid and len(values) and not values.values.null_count:
                    wide = values.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                    if np.isfinite(wide).all() and wide.any():
                        vector = wide.astype(kind).tobytes()
                        sign = hashlib.blake2b(f"{label}|".encode() + vector, digest_size=16).hexdigest()
                signs.append(sign)
                vectors.append(vector)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(signs, pa.string()), pa.array(vectors, pa.binary())],
                names=["vec_id", "label", "sign", "vector"],
            )

    picked = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding"
    )
    return picked.mapInArrow(run, "vec_id long, label string, sign string, vector binary")


def _probe(kind: str, tables: int, neighbours: int, scale: float, seed: int):
    names = ["bucket", "at", "probing", "sign", "weight", "vector", "own", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, labels, weights, vectors = (batch.column(c).to_pylist() for c in ("sign", "label", "weight", "vector"))
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for rows in by_size.values():
                x = np.stack([np.frombuffer(vectors[i], dtype=kind) for i in rows]).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                names_of = [f"{labels[i]}|{x.shape[1]}" for i in rows]
                own, around = [], []
                for t in range(tables):
                    o, a = cells(unit, t, neighbours, scale, seed)
                    own.append(_keys(o, t, names_of))
                    around.append(_keys(a, t, names_of))
                own_all, around_all = np.stack(own, axis=1), np.stack(around, axis=1)
                out: list[list] = [[] for _ in names]
                for r, i in enumerate(rows):
                    mine, near = own_all[r].tobytes(), around_all[r].tobytes()
                    for t in range(tables):
                        for probing, key in [(False, own_all[r, t]), *((True, k) for k in around_all[r, t])]:
                            for column, value in zip(
                                out, (int(key), t, probing, signs[i], weights[i], vectors[i], mine, near), strict=True
                            ):
                                column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def _finds(own: np.ndarray, around: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs (x, y) in one table: is y's cell among x's probes?"""
    wanted = own[y]
    found = np.zeros(len(x), dtype=bool)
    for probe in around.T:
        found |= probe[x] == wanted
    return found


def _meet(own: np.ndarray, around: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs (x, y): do they meet in this table at all?"""
    met = own[x] == own[y]
    rest = np.flatnonzero(~met)
    met[rest] = _finds(own, around, x[rest], y[rest]) | _finds(own, around, y[rest], x[rest])
    return met


def _bucket(own: np.ndarray, around: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs that meet in this table: the bucket that counts them."""
    bucket = own[x].copy()
    rest = np.flatnonzero(bucket != own[y])
    x, y = x[rest], y[rest]
    x_finds, y_finds = _finds(own, around, x, y), _finds(own, around, y, x)
    bucket[rest] = np.where(x_finds & y_finds, np.minimum(own[x], own[y]), np.where(x_finds, own[y], own[x]))
    return bucket


def _bucket_links(
    table: int, bucket: int, least: float, signs: np.ndarray, weights: np.ndarray, vectors: np.ndarray,
    own: np.ndarray, around: np.ndarray, probing: np.ndarray, left: np.ndarray, right: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """(links of each row in this bucket, pairs of rows that form a spanning forest)."""
    # cells by table; those of later tables do not tell where a pair meets first
    own = [np.ascontiguousarray(own[:, t]) for t in range(table + 1)]
    around = [np.asfortranarray(around[:, t]) for t in range(table + 1)]
    a, b = np.flatnonzero(left & ~probing), np.flatnonzero(right)
    links = np.zeros(len(signs), dtype=np.int64)
    joined = np.arange(len(signs))
    tree: list[tuple[int, int]] = []
    for at in range(0, len(a), 512):
        some = a[at : at + 512]
        i, j = np.nonzero(vectors[some] @ vectors[b].T >= least)
        x, y = some[i], b[j]
        # two index rows of a block meet once; a vector never meets itself
        once = (signs[x] != signs[y]) & (probing[y] | ~(left[y] & right[x]) | (signs[x] < signs[y]))
        x, y = x[once], y[once]
        for t in range(table):
            if len(x):
                later = ~_meet(own[t], around[t], x, y)
                x, y = x[later], y[later]
        if not len(x):
            continue
        here = _bucket(own[table], around[table], x, y) == bucket
        x, y = x[here], y[here]
        np.add.at(links, x, weights[y])
        np.add.at(links, y, weights[x])
        starts = np.flatnonzero(np.diff(x, prepend=-1))
        for p, others in zip(x[starts].tolist(), np.split(y, starts[1:]), strict=False):
            trees = joined[others]
            if (trees == joined[p]).all():
                continue
            trees, at_first = np.unique(trees, return_index=True)
            new = trees != joined[p]
            tree.extend((p, q) for q in others[at_first[new]].tolist())
            joined[np.isin(joined, trees[new])] = joined[p]
    return links, np.array(tree, dtype=np.int64).reshape(-1, 2)


def _compare(kind: str, tables: int, neighbours: int, least: float):
    """Links within each bucket of a group; a group holds a unit of a large bucket, or many small buckets."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        signs, others, links = [], [], []
        for _, same in rows.groupby(rows["vector"].map(len), sort=False):
            same = same.sort_values("bucket", kind="stable")
            vectors = np.stack([np.frombuffer(v, dtype=kind) for v in same["vector"]]).astype(np.float64)
            vectors /= np.abs(vectors).max(axis=1, keepdims=True)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            own = np.stack([np.frombuffer(v, dtype=np.int64) for v in same["own"]])
            around = np.stack([np.frombuffer(v, dtype=np.int64) for v in same["around"]]).reshape(len(same), tables, neighbours)
            names = ("sign", "weight", "probing", "as_left", "as_right", "bucket", "at")
            sign, weight, probing, left, right, bucket, table = (same[c].to_numpy() for c in names)
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(same)], strict=True):
                part = slice(at, end)
                n, ends = _bucket_links(
                    int(table[at]), int(bucket[at]), least, sign[part], weight[part], vectors[part],
                    own[part], around[part], probing[part], left[part], right[part],
                )
                some = np.flatnonzero(n)
                signs += [sign[part][some], sign[part][ends[:, 0]]]
                others += [np.full(len(some), None, dtype=object), sign[part][ends[:, 1]]]
                links += [n[some], np.zeros(len(ends), dtype=np.int64)]
        return pd.DataFrame({"sign": np.concatenate(signs), "links": np.concatenate(links), "other": np.concatenate(others)})

    return run


def near_vectors(
    rows: DataFrame, least: float = 0.98, tables: int = 3, neighbours: int = 4, scale: float = 1.0,
    seed: int = 7, block: int = 1024,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of vec_id, embedding, label.

    scale: cells per unit of distance; larger tables want finer cells and more neighbours.
    """
    kind = "<f4" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    spread = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    vectors = stored(usable_vectors(spread), "vectors")
    classes = stored(
        vectors.filter("sign is not null").groupBy("sign").agg(
            F.any_value("label").alias("label"), F.any_value("vector").alias("vector"),
            F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"),
        ), "vector_classes",
    )
    schema = "bucket long, at int, probing boolean, sign string, weight long, vector binary, own binary, around binary"
    probed = stored(
        classes.mapInArrow(_probe(kind, tables, neighbours, scale, seed), schema), "probes"
    )
    counts = probed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("probing")).alias("held"))
    counts = stored(counts.filter("n > 1 and held > 0").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "buckets")
    large = counts.filter("blocks > 1").select("bucket", "blocks")
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    met = probed.join(counts.select("bucket"), "bucket", "left_semi").join(large, "bucket", "left")
    n_blocks = F.coalesce("blocks", F.lit(1))
    own_block = F.pmod(F.xxhash64("sign"), n_blocks).cast("int")
    # unit (i, j): index rows of block i against all rows of block j; index rows against index rows for i <= j
    as_left = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda j: F.struct(F.col("mine").alias("i"), j.alias("j")))
    as_right = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda i: F.struct(i.alias("i"), F.col("mine").alias("j")))
    units = met.withColumn("mine", own_block).withColumn(
        "unit",
        F.explode(F.when(F.col("probing"), as_right).otherwise(F.array_union(as_left, as_right))),
    )
    units = units.withColumn("as_left", F.col("unit.i") == F.col("mine")).withColumn("as_right", F.col("unit.j") == F.col("mine"))
    # index rows meet index rows in the unit (i, j) with i <= j only
    units = units.withColumn("as_right", F.col("as_right") & (F.col("probing") | (F.col("unit.i") <= F.col("unit.j"))))
    units = units.filter("as_left or as_right")
    # buckets of one block share a group with others, about PACK_ROWS rows together
    total = counts.agg(F.sum("n")).first()[0] or 0
    packs = max(8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PACK_ROWS))
    small = F.col("blocks").isNull()
    units = units.withColumn("pack", F.when(small, F.pmod(F.xxhash64("bucket"), F.lit(packs)))).withColumn(
        "large", F.when(~small, F.col("bucket"))
    )
    found = units.select(
        "pack", "large", "unit", "bucket", "at", "probing", "sign", "weight", "vector", "own", "around", "as_left", "as_right"
    ).groupBy("pack", "large", "unit").applyInPandas(
        _compare(kind, tables, neighbours, least), "sign string, links long, other string"
    )
    found = stored(found, "vector_links")
    links = stored(found.filter("links > 0").groupBy("sign").agg(F.sum("links").alias("links")), "link_counts")
    roots = stored(components(found.filter("other is not null").select(F.col("sign").alias("a"), F.col("other").alias("b"))), "roots")
    rooted = classes.select("sign", "weight", "first_id").join(links, "sign", "left").join(
        roots, F.col("sign") == F.col("node"), "left"
    ).select("sign", "first_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "sign").alias("root"))
    rooted = stored(rooted, "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    by_sign = stored(rooted.join(smallest, "root").select("sign", "n_links", "component_id"), "by_sign")
    joined = vectors.select("vec_id", "sign").join(by_sign, "sign", "left")
    component = F.when(F.col("sign").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
