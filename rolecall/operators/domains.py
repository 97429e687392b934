"""Mail domain of each company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import text as T
from rolecall.functions import urls as U
from rolecall.functions.stage import settled
from rolecall.operators.skew import first_by


def domain_votes(hits: DataFrame) -> DataFrame:
    """Votes per (company, root domain) of search hits, job boards left out."""
    named = settled(hits.withColumn("domain", U.root_domain(F.col("url"))), "domain")
    return (
        named.filter(F.col("domain").isNotNull() & ~U.is_board_domain(F.col("domain")))
        .groupBy("company", "domain")
        .agg(F.count(F.lit(1)).alias("votes"), F.min("hit_rank").alias("first_rank"))
    )


def top_domains(votes: DataFrame) -> DataFrame:
    """Most voted domain per company, ties to the one seen first."""
    return first_by(votes, ["company"], [F.desc("votes"), "first_rank", "domain"])


def first_success(*tiers: Column) -> Column:
    """First non-blank answer in tier order."""
    return F.coalesce(*[T.blank_to_null(t) for t in tiers])


def company_domains(companies: DataFrame, *tiers: DataFrame) -> DataFrame:
    """Domain per company from ranked tiers of (company, domain), one row per company each."""
    out = companies
    for at, tier in enumerate(tiers):
        out = out.join(tier.select("company", F.col("domain").alias(f"_tier{at}")), "company", "left")
    names = [f"_tier{at}" for at in range(len(tiers))]
    answered = F.lit(None).cast("int")
    for at in reversed(range(len(names))):
        answered = F.when(F.coalesce(names[at], F.lit("")) != "", at + 1).otherwise(answered)
    return (
        out.withColumn("domain", first_success(*[F.col(n) for n in names]))
        .withColumn("tier", answered)
        .drop(*names)
    )
