"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecall.llm import (
    alignment, binary_tokens, lattice, lines, mixing, multiset, neighbours, packing, pseudonyms, ranked, rules, simhash, token_spans,
)
from rolecall.llm.common import table
from rolecall.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WORD_END, BYTE_END = 2, 1


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_binary_tokens(spark, sf_dir):
    path = work_path(spark, "tokens")
    binary_tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), WORD_END)
    read = binary_tokens.read_tokens(binary_tokens.token_index(spark, path), path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_source_mix(spark, sf_dir):
    mixed = mixing.taken_words(*mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_multiset_hash(spark, sf_dir):
    return multiset.compared(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark, sf_dir):
    return simhash.near_components(table(spark, sf_dir, "documents"))


@query
def op5_lattice(spark, sf_dir):
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_section_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_spans.section_tokens(docs, tokenizer_file("byte_bpe_50k.json"), sections=token_spans.line_chunks)


@query
def op10_harmonic_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), BYTE_END).drop("ids")


#: The key of the registered query only; a real run brings its own.
EXAMPLE_KEY = "example key"


@query
def op6_pseudonyms(spark, sf_dir):
    marked = pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), EXAMPLE_KEY)
    return marked.select("doc_id", "text", *map(_kind_count, pseudonyms.KINDS))


def _kind_count(kind: str):
    return F.size(F.filter("found", lambda x: x["kind"] == kind)).alias(f"n_{kind}")


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = neighbours.scored(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", neighbours.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op8_line_dedup(spark, sf_dir):
    kept = lines.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    left = F.coalesce(F.col("text"), F.lit(""))
    return kept.select(
        "doc_id", F.size("gone").alias("n_gone"), F.length(left).cast("long").alias("kept_chars"),
        F.md5(left.cast("binary")).alias("kept_md5"),
    )


@query
def op11_quality_rules(spark, sf_dir):
    found = rules.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op12_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return alignment.cross_aligned(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))[0]


@query
def op13_ranked_search(spark, sf_dir):
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
