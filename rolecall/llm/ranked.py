"""Operator 13: ranked lexical search with per-term geometric blocking.

Documents are scored for each item by the terms they share, term by term: weight of the term times a share that grows with
its occurrences and falls with the document's length. All of it is whole numbers.

1. Documents become vectors over the items' terms. Counts of all documents (N, L, document frequencies) are added up.
2. Each task cuts its documents into shards, and each shard is an index of its own: per term, a posting list of the shard's
   documents, clustered by similarity of the documents' vectors (seen through a random projection: a list's documents join the
   nearest of its representatives) and cut into blocks. A block stores, for each term, the largest share any of its
   documents has: its coordinatewise-maximum summary.
3. An item's score of a block's summary is an upper bound for every document in the block. A block is skipped only if that
   is less than the score of the item's k-th document so far; all others are scored in full. A posting list is left out only
   if the largest shares of all lists left out add up to less than that score. Both bounds hold exactly, ties included.
4. The best k of each task are merged in two steps, so no task gets k rows of every other one.

No posting is shuffled, and memory is bounded by a shard. Items are taken in blocks of about ``ITEMS``, whose terms are
sent to all tasks; each block is searched against all documents.

Defined results: a null, empty or termless text or item matches nothing and does not count in N; long texts are read whole;
repeated rows rank each by itself; equal scores rank by ascending doc_id, null ids last; an item row that repeats gets
ranks of its own only once (items are told apart by item_id and text); fewer matches than k give fewer rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecall.llm.common import stored
from rolecall.operators.skew import top_by

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
HITS = "item int, doc_id long, score long"
#: Items searched at once; documents of a shard; documents of a block; directions of the projection.
ITEMS, SHARD, BLOCK, DIRECTIONS = 10_000, 2048, 32, 16


def terms_of(text: str | None) -> list[str]:
    # bytes know only A-Z as capitals
    return TERM.findall(text.encode().lower().decode()) if text else []


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers in the vocabulary) and tfs of documents with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms_of(value.as_py())
                if found:
                    known = Counter(filter(None.__ne__, map(vocabulary.get, found)))
                    rows.append((doc_id, len(found), list(known), list(known.values())))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, VECTORS)


class Shard:
    """Index of some documents: per term, blocks of similar documents with their summaries.

    starts, terms, shares: documents' vectors as compressed rows. wanted: per term, the terms of all items that have it:
    nobody asks its blocks for others. weights: per term.
    """

    def __init__(self, ids: list, starts: np.ndarray, terms: np.ndarray, shares: np.ndarray, weights: np.ndarray,
                 wanted: list[np.ndarray], directions: np.ndarray, block: int = BLOCK):
        self.ids, self.weights = ids, weights
        self.dense = np.zeros((len(ids), len(weights)), dtype=np.int32)
        rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        self.dense[rows, terms] = shares
        places = self._places(rows, terms, shares, directions)
        order = np.lexsort((rows, terms))
        rows, terms = rows[order], terms[order]
        edges = np.flatnonzero(np.diff(terms, prepend=-1))
        self.lists = {}
        for s, e in zip(edges, np.append(edges, len(terms))[1:], strict=True):
            term = int(terms[s])
            members, firsts = self._blocks(rows[s:e], places, block)
            columns = wanted[term]
            summary = np.maximum.reduceat(self.dense[np.ix_(members, columns)], firsts, axis=0)
            top = int(self.dense[members, term].max())
            self.lists[term] = (members, firsts, summary, top)

    def _places(self, rows: np.ndarray, terms: np.ndarray, shares: np.ndarray, directions: np.ndarray) -> np.ndarray:
        """Documents as unit vectors in the projection's directions."""
        amounts = (shares * self.weights[terms]).astype(np.float32)[:, None] * directions[terms]
        sums = np.zeros((len(self.ids), directions.shape[1]), dtype=np.float32)
        np.add.at(sums, rows, amounts)
        return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

    @staticmethod
    def _blocks(members: np.ndarray, places: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Members in order of their clusters, and where each block of at most ``block`` begins."""
        if len(members) <= block:
            return members, np.array([0])
        kept = members[:: max(1, block // 2)]  # representatives, evenly spaced
        nearest = np.argmax(places[members] @ places[kept].T, axis=1)
        order = np.argsort(nearest, kind="stable")
        nearest = nearest[order]
        starts = np.flatnonzero(np.concatenate([[True], nearest[1:] != nearest[:-1]]))
        within = np.arange(len(nearest)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(nearest)]])))
        return members[order], np.flatnonzero(within % block == 0)

    def search(self, terms: np.ndarray, places: dict[int, np.ndarray], k: int, best: list[tuple], counts: list[int] | None = None) -> list[tuple]:
        """The item's best k of (score, doc_id) among ``best`` and this shard's documents.

        places: per term, where the item's terms are among the term's wanted ones. ``counts``: adds up blocks seen and skipped.
        """
        lists = [(int(self.weights[t]) * self.lists[t][3], int(t)) for t in terms.tolist() if t in self.lists]
        lists.sort(reverse=True)
        rest = sum(top for top, _ in lists)
        scored = np.zeros(len(self.ids), dtype=bool)
        weights = self.weights[terms]
        floor = best[-1][0] if len(best) == k else 1
        for top, term in lists:
            if rest < floor:
                break  # what is in none of the lists before cannot reach the floor
            rest -= top
            members, firsts, summary, _ = self.lists[term]
            bounds = summary[:, places[term]].astype(np.int64) @ weights
            open_blocks = bounds >= floor
            if counts is not None:
                counts[0] += len(bounds)
                counts[1] += int((~open_blocks).sum())
            if not open_blocks.any():
                continue
            sizes = np.diff(np.concatenate([firsts, [len(members)]]))
            chosen = members[np.repeat(open_blocks, sizes)]
            chosen = chosen[~scored[chosen]]
            scored[chosen] = True
            if not len(chosen):
                continue
            scores = self.dense[np.ix_(chosen, terms)].astype(np.int64) @ weights
            good = scores >= max(floor, 1)
            if good.any():
                found = [(int(s), self.ids[d]) for s, d in zip(scores[good], chosen[good], strict=True)]
                best = sorted([*best, *found], key=_rank)[:k]
                floor = best[-1][0] if len(best) == k else 1
        return best


def _rank(found: tuple) -> tuple:
    score, doc_id = found
    return -score, doc_id is None, doc_id or 0


def best_of_tasks(rows: DataFrame, items: list[np.ndarray], weights: np.ndarray, documents: int, occurrences: int, k: int) -> DataFrame:
    """item, doc_id, score: the best k of each task's documents; ``rows`` of ``vectors``."""
    vocabulary = len(weights)
    by_term: list[list[int]] = [[] for _ in range(vocabulary)]
    for no, terms in enumerate(items):
        for t in terms:
            by_term[t].append(no)
    directions = np.random.default_rng(13).choice(np.array([-1, 1], dtype=np.float32), (vocabulary, DIRECTIONS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [np.unique(np.concatenate([items[n] for n in numbers])) if numbers else np.array([], dtype=np.int64) for numbers in by_term]
        places = [{int(t): np.searchsorted(wanted[t], terms) for t in terms} for terms in items]
        best: list[list[tuple]] = [[] for _ in items]

        def searched(ids: list, held: list[tuple]) -> None:
            n, sizes, terms, tfs = (np.concatenate(x) for x in zip(*held, strict=True))
            lengths = 50 + 50 * n * documents // occurrences
            shares = 1_000_000_000 * tfs // (1000 * tfs + 20 * np.repeat(lengths, sizes))
            shard = Shard(ids, np.concatenate([[0], np.cumsum(sizes)]), terms, shares, weights, wanted, directions)
            for no, asked in enumerate(items):
                best[no] = shard.search(asked, places[no], k, best[no])

        ids, held = [], []
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                part = batch.slice(at, SHARD)
                ids += part.column("doc_id").to_pylist()
                lists = part.column("terms")
                sizes = np.diff(lists.offsets.to_numpy())
                held.append((
                    part.column("n").to_numpy().astype(np.int64), sizes.astype(np.int64),
                    lists.flatten().to_numpy().astype(np.int64), part.column("tfs").flatten().to_numpy().astype(np.int64),
                ))
                if len(ids) >= SHARD:
                    searched(ids, held)
                    ids, held = [], []
        if ids:
            searched(ids, held)
        found = [(no, doc_id, score) for no, rows in enumerate(best) for score, doc_id in rows]
        if found:
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int32(), pa.int64(), pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, HITS)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the best ``k`` documents of each item with a score above 0."""
    asked = stored(items.select("item_id", "text").distinct(), "items")
    blocks = max(1, math.ceil(asked.count() / ITEMS))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = [_searched(docs, asked.filter(number == b), k) for b in range(blocks)]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def _searched(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """``search`` for about ``ITEMS`` items: their texts reach the driver, all else stays with the tasks."""
    spark = docs.sparkSession
    listed = items.orderBy("item_id", "text").collect()
    found = [sorted(set(terms_of(r.text))) for r in listed]
    vocabulary = {t: no for no, t in enumerate(sorted(set().union(*found)))}
    numbered = [np.array([vocabulary[t] for t in terms], dtype=np.int64) for terms in found]
    rows = stored(vectors(docs, vocabulary), "vectors")
    documents, occurrences = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    # one count per term of the items
    held = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect())
    weights = np.array([weight(documents, held.get(t, 0)) for t in range(len(vocabulary))], dtype=np.int64)
    local = best_of_tasks(rows, numbered, weights, documents, occurrences or 1, k)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    # first within groups of tasks, then of those: neither step gets rows of all tasks at one place
    groups = max(1, math.isqrt(len(rows.inputFiles())))
    some = top_by(local.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups))), ["item", "_group"], order, k)
    ranked = top_by(some, ["item"], order, k, "rank")
    names = spark.createDataFrame([(no, None if r.item_id is None else int(r.item_id)) for no, r in enumerate(listed)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
