"""Fields extracted by an outside model, posting keys, drafts and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.functions import text as T
from rolecall.functions.stage import settled
from rolecall.session import last_of_repeated_keys


def checked_responses(responses: DataFrame) -> DataFrame:
    """Model answers (response, page_title) to posting fields.

    Adds job_title, company, job_family, location and ``problem``: null when the answer is
    usable, else why it is not. Unusable answers keep null fields. The last of repeated keys counts.
    """
    last_of_repeated_keys(responses.sparkSession)
    fenced = T.strip(F.col("response"))
    bare = F.regexp_replace(
        F.regexp_replace(fenced, rf"\A```(?:json)?[{T.WS}]*", ""), rf"[{T.WS}]*```\z", ""
    )

    def kind(field: str) -> Column:
        """JSON type of a field; null when the key is missing."""
        return F.schema_of_variant(F.try_variant_get("_json", f"$.v.{field}", "variant"))

    def value(field: str) -> Column:
        return F.try_variant_get(F.col("_json"), f"$.v.{field}", "string")

    # the parser ignores what follows a value; only one whole value fits both wrappings
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), F.col("_bare"), F.lit("}")))
    as_item = F.try_parse_json(F.concat(F.lit("["), F.col("_bare"), F.lit("]")))
    typed = responses.withColumn("_bare", bare).withColumn(
        "_json", F.when(as_item.isNotNull(), as_field)
    )
    for field in ("job_title", "company", "job_family", "location"):
        typed = typed.withColumn(f"_{field}_kind", F.coalesce(kind(field), F.lit("MISSING")))
        typed = typed.withColumn(f"_{field}", value(field))
    typed = typed.withColumn(
        "_kind", F.schema_of_variant(F.try_variant_get("_json", "$.v", "variant"))
    )
    text_or_missing = F.lit(True)
    for field in ("job_title", "company", "job_family"):
        text_or_missing = text_or_missing & F.col(f"_{field}_kind").isin("STRING", "MISSING")
    problem = (
        F.when(F.col("_json").isNull(), "not json")
        .when(~F.col("_kind").startswith("OBJECT"), "not an object")
        .when(~text_or_missing, "field is not text")
        .when(~F.col("_location_kind").isin("STRING", "MISSING", "VOID"), "location is not text")
    )
    families = [name for name, _ in K.JOB_FAMILIES]
    named = F.coalesce("_job_family", F.lit(K.DEFAULT_FAMILY))
    ok = F.col("problem").isNull()
    title = T.blank_to_null(T.strip(F.coalesce("_job_title", F.lit(""))))
    family = F.when(named.isin(families), named).otherwise(N.closest_family(named))
    checked = (
        typed.withColumn("problem", problem)
        .withColumn("job_title", F.when(ok, F.coalesce(title, F.col("page_title"))))
        .withColumn("company", F.when(ok, T.strip(F.coalesce("_company", F.lit("")))))
        .withColumn("job_family", F.when(ok, family))
        .withColumn("location", F.when(ok, T.blank_to_null(F.col("_location"))))
    )
    fields = ["job_title", "company", "job_family", "location", "problem"]
    return settled(checked.drop(*[c for c in checked.columns if c.startswith("_")]), *fields)


def quality_flags(postings: DataFrame) -> DataFrame:
    """Flag fields that look unextracted."""
    company = F.lower(F.coalesce("company", F.lit("")))
    return postings.withColumn("company_doubtful", company.isin("", "unknown", "n/a")).withColumn(
        "title_blank", F.coalesce("job_title", F.lit("")) == ""
    )


def with_posting_key(postings: DataFrame) -> DataFrame:
    return postings.withColumn(
        "job_key", T.posting_key(F.col("company"), F.col("job_title"), F.col("scraped_at"))
    )


def with_default_time(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Rows without a time get the run's time."""
    return df.withColumn(column, F.coalesce(F.col(column), as_of))


def with_subject(postings: DataFrame) -> DataFrame:
    return postings.withColumn(
        "email_subject", T.subject_line(F.col("job_title"), F.col("company"))
    )


def with_analysis_prompt(texts: DataFrame) -> DataFrame:
    return texts.withColumn("prompt", T.analysis_prompt(F.col("raw_text")))


def with_draft_prompt(postings: DataFrame, resume: DataFrame, first: str = "there") -> DataFrame:
    """One prompt per posting; ``resume`` is a single row, read as a scalar subquery."""
    text = F.coalesce(resume.select("text").scalar(), F.lit(""))
    return postings.withColumn(
        "prompt",
        T.draft_prompt(
            F.lit(first), F.col("company"), F.col("job_title"), F.col("url"),
            F.col("description"), text,
        ),
    )


def apply_drafts(postings: DataFrame, drafts: DataFrame) -> DataFrame:
    """Patch subject and body where a draft exists; every other column stays. Keys are unique."""
    new = drafts.select(
        "job_key", F.col("email_subject").alias("_subject"), F.col("email_body").alias("_body")
    )
    return (
        postings.join(new, "job_key", "left")
        .withColumn("email_subject", F.coalesce("_subject", "email_subject"))
        .withColumn("email_body", F.coalesce("_body", "email_body"))
        .drop("_subject", "_body")
    )


def has_draft() -> Column:
    return (F.coalesce("email_subject", F.lit("")) != "") & (
        F.coalesce("email_body", F.lit("")) != ""
    )


def split_drafted(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings ready to send for, postings still lacking a subject or body)."""
    return postings.filter(has_draft()), postings.filter(~has_draft())
