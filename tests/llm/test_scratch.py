"""Tables of a step go when it ends, so the pipeline's disk does not add up from stage to stage."""

from pathlib import Path

import pytest

from rolecall.llm import lines
from rolecall.session import scratch, shared_folder, stored

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _tables(spark):
    return {str(p) for p in Path(shared_folder(spark), "rolecall").rglob("*-*") if p.is_dir()}


def test_tables_go_with_their_step(spark):
    with pytest.raises(KeyError), scratch(spark, "step") as keep:
        keep(spark.range(3), "numbers")
        before = _tables(spark)
        raise KeyError
    assert {Path(p).name.split("-")[0] for p in before - _tables(spark)} == {"step", "numbers"}
    with scratch(spark, "step") as keep:
        left = stored(keep(spark.range(3), "numbers"), "left")
    assert left.count() == 3


def test_line_dedup_leaves_line_numbers_only(spark, odd_docs):
    before = _tables(spark)
    found = lines.without_repeats(odd_docs, word_edits=corpus_pipeline.WORD_EDITS)
    assert found.count() == odd_docs.count()
    assert {Path(p).name.split("-")[0] for p in _tables(spark) - before} == {"line_gone", "line_near_pairs"}
