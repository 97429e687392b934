"""The pipeline's stages, each held against what its operator must do to the stage's input."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf_dir, odd_docs, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{at}")
        out = spark.read.parquet(f"{tmp_path}/{at}")
        before, after = docs.collect(), out.collect()
        ids = {r.doc_id for r in after}
        if name != "pack":
            assert sorted(out.columns) == sorted(corpus_pipeline.COLUMNS)
        if name == "quality":
            good = [d.doc_id for d in before if labels.get(d.doc_id) == 1]
            assert sum(d in ids for d in good) >= 0.95 * len(good)
            assert sum(d.doc_id in ids for d in before if labels.get(d.doc_id) == 0) <= 2
        if name == "line_dedup":
            seen = [t for r in after for t in r.text.split("\n") if len(t.strip()) >= 24]
            assert len(seen) == len(set(seen)) and all(r.n_chars == len(r.text) for r in after)
        if name == "near_dedup":
            assert len({r.text for r in after}) == len(after)
        if name == "source_mix":
            assert len(after) <= 3 * len(before) and ids <= {r.doc_id for r in before}
        if name == "pack":
            assert sum(r.length for r in after) == sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in after if r.start == 0}.get((r.doc_id, r.doc_tokens), 0) for r in after if r.start == 0)
        docs = out


def test_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() >= 0
