"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecall.llm import lines, mixing, neighbours, packing, simhash
from rolecall.llm.common import stored, table
from rolecall.llm.queries import BYTE_END, tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words that may differ between near lines of at least twenty words.
WORD_EDITS = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    found = neighbours.scored(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return found.filter("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in an earlier one, or nearly; those left without a word go."""
    kept = lines.without_repeats(docs.select(*COLUMNS), word_edits=WORD_EDITS)
    kept = kept.filter((F.size("gone") == 0) | F.col("text").rlike(mixing.WORD))
    return kept.withColumn(
        "n_chars", F.when(F.size("gone") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; one a source may be taken in part."""
    taken = mixing.mixed_documents(docs.select(*COLUMNS))
    cut = F.length("text") < F.col("n_chars")
    n_chars = F.when(cut, F.length("text")).otherwise(F.col("n_chars"))
    return taken.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, sequence and place."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), BYTE_END)


STAGES = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix), ("pack", pack),
]

#: The classifier is no SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
