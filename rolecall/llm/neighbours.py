"""Operator 7: document quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed features: its words, their shapes (letter case, digits, marks), pairs of
shapes, and whether a word repeats the one before. Counts are damped, weighted by how rare a feature is among
all documents, and projected to ``latent`` dimensions: the leading singular directions of a bounded sample of
labelled training documents (``sample`` per class, those of smallest hashed id). The sample's labelled
vectors are broadcast; their size is bounded by ``sample``, whatever the input. Every document's
cosines with all of them are computed exactly, in blocks, and its ``nearest`` vote with their labels, each
weighted by a power of its cosine.

Labels are learned only from rows outside the held-out third. A score depends on the text alone: equal texts have
equal scores. Labelled documents whose vector equals a text's have no vote on it, so no document votes on itself.

Defined results: a null, empty or blank text, or one without any neighbour, scores the share of label 1
among all training labels; without any training label that is 0.5; null ids are scored, not learned from;
label rows that are null or contradict each other are not learned from; repeated rows are scored once each; an
empty table gives no rows; other columns are kept, not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS, SHAPES = 4096, 1024
FEATURES = WORDS + SHAPES
#: Cosine of equal vectors, to single precision.
SAME = 1 - 2e-6
_RUNS = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _shape(word: str) -> str:
    """Case, digits and marks of a word: "Then," is "Aa,", "THE!!" is "A!!"."""
    kept = []
    for c in word:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c
        if kept[-2:] != [kind, kind]:
            kept.append(kind)
    out = "".join(kept).replace("AA", "A").replace("aa", "a").replace("99", "9")
    return out[:8]


class _Words(dict):
    """Word to ``word feature * SHAPES + shape feature``; what is known of short words is remembered."""

    def __init__(self, remembered: int):
        super().__init__()
        self.remembered = remembered

    def __missing__(self, word: str) -> int:
        # most words are letters and at most one mark at their end
        body, mark = (word, "") if word[-1:].isalnum() else (word[:-1], word[-1:])
        if body.isalpha() and (body.islower() or body[1:].islower() and body[0].isupper()):
            plain, shape = body.lower(), ("a" if body.islower() else "Aa") + mark
        else:
            plain, shape = "".join(c for c in word.lower() if c.isalnum()), _shape(word)
        found = zlib.crc32(plain.encode()) % WORDS * SHAPES + zlib.crc32(shape.encode()) % (SHAPES - 1)
        if len(word) <= 48:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = found
        return found


class Features:
    """Hashed feature counts of texts; a word repeats the one before when both give the same features."""

    def __init__(self, remembered: int = 400_000):
        self.words = _Words(remembered)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(features, damped counts), the features in order."""
        words = (text or "").split()
        if not words:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
        codes = np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))
        plain, shapes = codes // SHAPES, codes % SHAPES
        pairs = (shapes[:-1] * 31 + shapes[1:] * 17 + 7) % (SHAPES - 1)
        counts = np.bincount(np.concatenate([plain, WORDS + shapes, WORDS + pairs]), minlength=FEATURES)
        counts[FEATURES - 1] = np.count_nonzero(codes[1:] == codes[:-1])
        found = np.flatnonzero(counts)
        return found.astype(np.int32), np.log1p(counts[found]).astype(np.float32)


_FEATURES = Features()


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, in how many each feature occurs), over all of them; 5,121 numbers come back."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen[_FEATURES(text.as_py())[0]] += 1
            n += batch.num_rows
        seen[FEATURES] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(seen)], names=["feature", "n"])

    sums = docs.select("text").mapInArrow(tally, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = dict(sums.collect())
    return int(found.get(FEATURES, 0)), np.array([found.get(i, 0) for i in range(FEATURES)], dtype=np.float64)


def training_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list, float]:
    """([(doc_id, label, features, counts)], share of label 1 among all training labels).

    At most ``sample`` documents of each label.
    """
    one = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("_most")
    ).filter("label = _most").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    train = one.filter(~held_out(F.col("doc_id")))
    prior = train.agg(F.avg(F.col("label").cast("double"))).first()[0]
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = train.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= sample).drop("_at")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_FEATURES(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([f.tolist() for f, _ in found], pa.list_(pa.int32())),
                 pa.array([c.tolist() for _, c in found], pa.list_(pa.float32()))],
                names=["doc_id", "label", "features", "counts"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(picked), "doc_id").mapInArrow(
        features, "doc_id long, label int, features array<int>, counts array<float>"
    )
    # repeated rows of a document count once; the sample's size is bounded, so it may come to the driver
    rows = rows.dropDuplicates(["doc_id"])
    return sorted(rows.collect(), key=lambda r: r["doc_id"]), 0.5 if prior is None else float(prior)


def latent_directions(matrix: np.ndarray, latent: int, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors, by randomised subspace iteration."""
    rng = np.random.default_rng(seed)
    width = min(latent + 16, *matrix.shape)
    basis = np.linalg.qr(matrix.T @ (matrix @ rng.normal(size=(matrix.shape[1], width)).astype(np.float32)))[0]
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, turned = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ turned.T)[:, :latent].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, latent: int = 48) -> dict:
    """Everything a task needs: weights, directions, labelled vectors."""
    rows, prior = training_sample(docs, labels, sample)
    n, seen = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + seen)) + 0.05).astype(np.float32)
    idf[FEATURES - 1] += 1  # repeated words weigh like a rare feature
    model = {"prior": prior, "idf": idf, "ids": np.zeros(0, dtype=np.int64)}
    rows = [r for r in rows if len(r["features"])]
    if not rows:
        return model
    matrix = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for i, r in enumerate(rows):
        matrix[i, r["features"]] = np.array(r["counts"], dtype=np.float32) * idf[r["features"]]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    directions = latent_directions(matrix, latent)
    vectors = matrix @ directions
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return model | {
        "directions": directions, "vectors": np.ascontiguousarray(vectors.T),
        "labels": np.array([r["label"] for r in rows], dtype=np.float32),
        "ids": np.array([r["doc_id"] for r in rows], dtype=np.int64),
    }


def vote(model: dict, vectors: np.ndarray, nearest: int, power: float) -> np.ndarray:
    """Scores of a block of unit vectors (zero vectors: no neighbours). Labelled vectors equal to one do not vote on it."""
    if not len(model["ids"]):
        return np.full(len(vectors), model["prior"])
    cosines = vectors @ model["vectors"]
    cosines[cosines > SAME] = 0
    k = min(nearest, cosines.shape[1])
    best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weights = np.maximum(np.take_along_axis(cosines, best, axis=1), 0).astype(np.float64) ** power
    total = weights.sum(axis=1)
    voted = (weights * model["labels"][best]).sum(axis=1)
    return np.where(total > 1e-12, voted / np.maximum(total, 1e-12), model["prior"])


def scored(
    docs: DataFrame, labels: DataFrame, sample: int = 2000, latent: int = 48, nearest: int = 15, power: float = 4.0
) -> DataFrame:
    """``docs`` with score and predicted; columns so called are replaced, doc_id comes first."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels, sample, latent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            scores = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                vectors = np.zeros((part.num_rows, m["directions"].shape[1] if len(m["ids"]) else 1), dtype=np.float32)
                if len(m["ids"]):
                    for i, text in enumerate(part.column("text")):
                        features, counts = _FEATURES(text.as_py())
                        if len(features):
                            vectors[i] = (counts * m["idf"][features]) @ m["directions"][features]
                    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                scores.append(vote(m, vectors, nearest, power))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(score, 0, 1))], names=[*batch.schema.names, "score"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "score", "predicted")])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    out = kept.mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
