"""The pipeline's near dedup against fingerprints and links worked out one by one."""

import re
from collections import Counter
from itertools import combinations

import pytest
import xxhash

from rolecall.llm import simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, k in ones.items() if 2 * k > len(shingles))


def _components(docs):
    marks = {d: _fingerprint(t) for d, t in docs}
    root = {d: d for d in marks}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(marks), 2):
        if (marks[a] ^ marks[b]).bit_count() <= 2:
            one, other = sorted((top(a), top(b)))
            root[other] = one
    return marks, {d: top(d) for d in marks}


def test_stage_keeps_the_first_of_each_group(spark, sf_dir):
    long = " ".join(f"word{i % 500}" for i in range(3000))
    planted = [(-3, long), (-2, long + " one more"), (-1, long.upper()), (-9, None), (-8, " \n"), (-7, "Ä ä")]
    real = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in real.collect()] + planted
    marks, first = _components(docs)
    df = spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars int")
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()]
    assert sorted(kept) == sorted(set(first.values())) and len(kept) < len(docs) - 3
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_components(df).collect()}
    assert found == {d: (f"{m:016x}", first[d]) for d, m in marks.items()}
