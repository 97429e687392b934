"""Sinks: posting documents and plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolecall import schemas as S
from rolecall.operators.pages import KEY_BITS, held
from rolecall.session import stored
from rolecall.sources import folders

LIST_SIZE = 1000
#: Keys that are joined by broadcast; more, by an ordinary join.
BROADCAST_KEYS = 100_000
#: Stored bytes that one task writes again.
TASK_BYTES = 128 << 20


def nested_contacts(contacts: DataFrame, list_size: int = LIST_SIZE) -> DataFrame:
    """Contact lists in the stored form: job_key, part, recruiters.

    contact_rank counts 1, 2, ... within a posting. A list holds ``list_size`` contacts; a
    longer one goes on in further parts, so no posting is gathered into one huge record.
    """
    stored = F.struct(
        "name", "title", "linkedin_url",
        F.nullif(F.array_join("candidates", ","), F.lit("")).alias("email"),
        "source", "found_at", "email_sent_at", "email_sent_to", "email_tried", "email_bounced",
    )
    part = F.floor((F.col("contact_rank") - 1) / list_size).cast("int")
    return (
        contacts.groupBy("job_key", part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("contact_rank", stored.alias("contact")))).alias("recruiters"))
        .withColumn("recruiters", F.col("recruiters.contact"))
    )


def upsert_contacts(docs: DataFrame, nested: DataFrame) -> DataFrame:
    """Documents with the whole contact list replaced where a new one is given.

    Everything else of a document stays; its unknown keys (``rest``) stay with the first part of the list.
    """
    least = F.min("part").over(Window.partitionBy("job_key"))
    new = nested.select(
        F.col("job_key").alias("_key"), F.col("part").alias("_part"), F.col("recruiters").alias("_list"), (F.col("part") == least).alias("_least")
    )
    first = F.coalesce("part", F.lit(0)) == 0
    # one join: the first part of a document meets all new parts, a further part only shows that it has gone
    met = docs.join(new, (F.col("job_key") == F.col("_key")) & (first | F.col("_least")), "left").filter(F.col("_key").isNull() | first)
    given = F.col("_key").isNotNull()
    changed = {"part": F.when(given, F.col("_part")).otherwise(F.col("part")), "recruiters": F.when(given, F.col("_list")).otherwise(F.col("recruiters"))}
    if "rest" in docs.columns:
        changed["rest"] = F.when(~given | (F.col("_part") == 0), F.col("rest"))
    return met.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def document_line(columns: list[str]) -> Column:
    """A document as one line of JSON: its columns, and beside them the keys of ``rest`` that are no columns."""
    fields = [c for c in columns if c != "rest"]
    own = F.to_json(F.struct(*fields))
    if "rest" not in columns:
        return own
    others = F.map_filter("rest", lambda key, _: ~key.isin(*fields))
    return F.when(F.col("rest").isNull(), own).otherwise(F.to_json(F.map_concat(others, F.from_json(own, S.REST))))


def write_lines(rows: DataFrame, path: str, part: str) -> None:
    """Lines of JSON (``value``) in folders by ``part``; folders without new rows stay."""
    # plain lines under the name of JSON files: JSON holds no raw control characters, so nothing is quoted
    plain = {"sep": "\x01", "quote": "\x00", "escape": "\x00", "extension": "json"}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**plain)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.partitionBy(part).csv(path)


def without_keys(old: DataFrame, fresh: DataFrame, key: str = "job_key", bits: int = KEY_BITS) -> DataFrame:
    """Rows of ``old`` whose ``key`` is none of ``fresh``; null is one key. Both are read twice.

    Rows are tested against a bitmap of the new keys where they are read; those that it holds by chance are
    found exactly, by their keys alone, and kept. So keys are shuffled, and whole rows only if such keys are very many.
    """
    keys = fresh.select(F.col(key).alias("_new")).distinct()
    met = held(old, fresh.select(key), [key], bits=bits)
    same = F.col(key).eqNullSafe(F.col("_new"))
    spared = stored(met.filter("_held").select(key).distinct().join(keys, same, "left_anti"), "spared").withColumnRenamed(key, "_new")
    spared = spared.withColumn("_spared", F.lit(True))
    spared = F.broadcast(spared) if spared.count() <= BROADCAST_KEYS else spared
    rest = met.join(spared, same, "left").filter(~F.col("_held") | F.col("_spared"))
    return rest.drop("_held", "_new", "_spared")


def write_postings(postings: DataFrame, path: str, parts: int = 64) -> None:
    """Add or replace postings by key; all others stay, line by line as they were.

    One JSON object per line, in folders by a hash of the posting key. Only folders that hold a
    written key are read and written again; a null key is one key. A column called ``rest`` holds
    keys of the document that are no columns: they are written beside the others. Lines that stay go
    from the files read to the files written, which take their place when all are written.
    """
    spark = postings.sparkSession
    number = F.conv(F.substring(F.md5(F.coalesce("job_key", F.lit(""))), 1, 4), 16, 10).cast("int")
    line = document_line(postings.columns)
    keyed = postings.select("job_key", line.alias("value"), (number % parts).alias("_part"))
    size = folders.size(spark, path)
    if not size:
        write_lines(keyed.select("value", "_part"), path, "_part")
        return
    fresh = stored(keyed, "postings", compression="zstd")
    touched = [r[0] for r in fresh.select("_part").distinct().collect()]  # at most ``parts`` numbers
    old = spark.read.schema("value string, _part int").text(path).filter(F.col("_part").isin(touched))
    old = old.withColumn("job_key", F.get_json_object("value", "$.job_key"))
    merged = without_keys(old, fresh).select("value", "_part").unionByName(fresh.select("value", "_part"))
    # tasks by size, not by files, so that files do not grow in number from write to write
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    write_lines(merged.coalesce(tasks), path, "_part")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
