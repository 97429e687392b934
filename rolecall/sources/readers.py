"""Sources: pages, posting documents, contacts, notices, text documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolecall import schemas as S
from rolecall.functions import text as T
from rolecall.session import last_of_repeated_keys
from rolecall.sources.listing import list_files
from rolecall.sources.writers import LIST_SIZE


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table. One stored in fewer splits than there are cores is spread over them;
    a large table has more splits than cores and is read as it is."""
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PAGES).parquet(path)


def _fields_and_rest(docs: DataFrame) -> DataFrame:
    """The fields of whole documents (``doc``, a variant) and ``rest``, the keys that are none; null without any."""
    fields = StructType.fromDDL(S.POSTING_DOCS)
    known = [F.try_variant_get("doc", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]
    others = F.map_filter(F.try_variant_get("doc", "$", S.REST), lambda key, _: ~key.isin(*fields.names))
    return docs.select(*known, F.when(F.size(others) > 0, others).alias("rest"))


def read_postings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Posting documents, one JSON object per line; missing keys are null, unknown ones are kept in ``rest``."""
    last_of_repeated_keys(spark)
    return _fields_and_rest(spark.read.option("singleVariantColumn", "doc").json(path))


def read_posting_files(spark: SparkSession, path: str) -> DataFrame:
    """Posting documents written by hand or by other tools, one indented object per file; as ``read_postings``."""
    last_of_repeated_keys(spark)
    return _fields_and_rest(spark.read.option("singleVariantColumn", "doc").option("multiLine", True).json(path))


def list_postings(spark: SparkSession, path: str) -> DataFrame:
    """Stored files, newest first; a missing path gives no rows. File contents are not read, and the driver holds no listing."""
    return list_files(spark, path, ".json").orderBy(F.desc("modificationTime"), "path")


def split_addresses(email: Column) -> Column:
    """Comma-joined addresses to a list without blanks."""
    parts = F.split(F.coalesce(email, F.lit("")), ",")
    # plain text without blanks, as most lists are, is not looked at address by address
    stripped = F.when(email.rlike(r"^[!-~]*+\z"), parts).otherwise(F.transform(parts, T.strip))
    return F.array_remove(stripped, "")


def contacts_from_docs(docs: DataFrame, list_size: int = LIST_SIZE) -> DataFrame:
    """One row per stored contact, in list order; documents without any give none."""
    offset = F.coalesce("part", F.lit(0)) * list_size
    rows = docs.select("job_key", offset.alias("_from"), F.posexplode("recruiters").alias("_at", "_c"))
    return rows.select(
        "job_key",
        (F.col("_from") + F.col("_at") + 1).alias("contact_rank"),
        "_c.name", "_c.title", "_c.linkedin_url",
        split_addresses(F.col("_c.email")).alias("candidates"),
        F.coalesce("_c.source", F.lit("google")).alias("source"),
        "_c.found_at", "_c.email_sent_at", "_c.email_sent_to",
        F.coalesce("_c.email_tried", F.array().cast("array<string>")).alias("email_tried"),
        "_c.email_bounced",
    )


def read_text_docs(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, trimmed: path, text."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), T.strip(F.col("value")).alias("text")
    )


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.NOTICES).json(path)


def stream_notices(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages as a stream of JSON lines; a line that is no message keeps its text in ``_corrupt_record``."""
    lines = spark.readStream.schema(f"{S.NOTICES}, _corrupt_record string")
    return lines.option("maxFilesPerTrigger", files_per_batch).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def split_notices(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages, lines that are none: record); of stored messages, since a text's reader may skip unused columns."""
    broken = F.col("_corrupt_record").isNotNull()
    return messages.filter(~broken).drop("_corrupt_record"), messages.filter(broken).select(F.col("_corrupt_record").alias("record"))
