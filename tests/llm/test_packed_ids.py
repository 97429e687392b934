"""Packed token ids are written, and digests are those of the ids that are read."""

import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rolecall.llm import packing
from rolecall.llm.queries import QUERIES
from rolecall.session import shared_folder

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _pieces(spark):
    return set(Path(shared_folder(spark), "rolecall").glob("pieces-*"))


def test_query_stores_ids(spark, sf_dir):
    before = _pieces(spark)
    rows = QUERIES["op10_harmonic_pack"](spark, sf_dir)
    (path,) = _pieces(spark) - before
    held = spark.read.parquet(str(path)).collect()
    assert all(len(r.ids) == 4 * r.length for r in held)
    expected = sorted((r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in held)
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows.collect()) == expected


def test_stage_gives_sequences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    placed = corpus_pipeline.pack(spark, docs, sf_dir)
    full = packing.sequences(placed, 2048, 0).select("sequence_id", F.length("ids").alias("n")).collect()
    assert len(full) == placed.select("sequence_id").distinct().count()
    assert all(r.n == 4 * 2048 or (r.n // 4).bit_count() == 1 for r in full)
