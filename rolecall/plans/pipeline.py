"""The three end-to-end runs as lazy plans over whole tables.

Failures are quarantine rows, not exits: each step that can fail has a split that gives
the usable rows and the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.operators import addresses, domains, outreach, pages, postings, reconcile, search
from rolecall.operators.skew import first_by


def posting_run(
    crawled: DataFrame, answers: DataFrame, as_of: Column, payloads: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(postings, quarantine) from crawled pages, board API answers and the model's answers to their text.

    answers: canonical_url, response. payloads: url, body. One text and one answer per address
    count; a page without an answer is quarantined.
    """
    # usable and failed texts go one way, so that either result reads every page once
    texts = pages.routed_texts(crawled, payloads).filter(F.col("success").isNotNull())
    one_answer = first_by(answers.select("canonical_url", "response"), ["canonical_url"], [F.col("response").isNull(), "response"])
    # one row per address on both sides, so no address is hot
    answered = texts.join(one_answer.withColumn("has_answer", F.lit(True)), "canonical_url", "left")
    checked = postings.checked_responses(answered).withColumn(
        "problem",
        F.when(~F.col("success"), F.col("error")).when(F.col("has_answer").isNull(), "no answer").otherwise(F.col("problem")),
    ).drop("has_answer")
    stamped = postings.with_default_time(
        checked.withColumn("scraped_at", F.lit(None).cast("timestamp")), "scraped_at", as_of
    )
    good = postings.with_posting_key(
        postings.quality_flags(stamped.filter(F.col("problem").isNull()))
    ).select(
        "job_key", F.col("canonical_url").alias("url"), "platform", "job_title", "company",
        "job_family", "location", F.col("raw_text").alias("description"),
        F.lit(None).cast("string").alias("email_subject"),
        F.lit(None).cast("string").alias("email_body"),
        "scraped_at", "company_doubtful", "title_blank",
    )
    bad = checked.filter(F.col("problem").isNotNull()).select("canonical_url", "problem")
    return good, bad


def contact_run(
    jobs: DataFrame,
    hits: DataFrame,
    log: DataFrame,
    companies: DataFrame,
    as_of: Column,
    max_results: int = K.MAX_RESULTS,
    save: Callable[[DataFrame], DataFrame] = lambda found: found,
) -> DataFrame:
    """Contacts with candidate addresses, from search hits and the fetch log.

    companies: company, domain, pattern, one row per company. ``save`` may keep the found
    contacts before their addresses are looked for, so that step can be repeated alone.
    """
    used = search.sticky_backends(search.fetch_outcomes(log))
    named = search.profile_hits(search.answered_hits(hits, used))
    found = search.capped_contacts(search.first_seen(named), max_results)
    # at most max_results rows per posting are left, so no posting is hot in this join
    rows = found.join(jobs.select("job_key", "company"), "job_key").select(
        "job_key", "company", "contact_rank", "name", F.col("role").alias("title"),
        F.col("url").alias("linkedin_url"),
        F.array().cast("array<string>").alias("candidates"),
        "source", as_of.alias("found_at"),
        F.lit(None).cast("timestamp").alias("email_sent_at"),
        F.lit(None).cast("string").alias("email_sent_to"),
        F.array().cast("array<string>").alias("email_tried"),
        F.lit(None).cast("boolean").alias("email_bounced"),
    )
    return addresses.contact_addresses(save(rows), companies).drop("company", "domain", "pattern")


def company_run(snippets: DataFrame, hits: DataFrame) -> DataFrame:
    """(company, domain, pattern) from search hits and address snippets."""
    top = domains.top_domains(domains.domain_votes(hits)).select("company", "domain")
    mined = addresses.mined_addresses(snippets.select("title", "content", "url"), ["title", "content", "url"])
    patterns = addresses.top_patterns(addresses.pattern_votes(mined, top))
    return top.join(patterns.select("domain", "pattern"), "domain", "left")


def send_run(
    contacts: DataFrame,
    jobs: DataFrame,
    notices: DataFrame,
    as_of: Column,
    lookback: int = K.LOOKBACK_MINUTES,
    sender: str = "",
    max_send: int = K.MAX_SEND,
) -> tuple[DataFrame, DataFrame]:
    """(contacts after the bounce check, outbox)."""
    since = reconcile.cutoff(as_of, lookback)
    addresses_gone = reconcile.bounced_addresses(reconcile.bounce_notices(notices), since)
    checked = reconcile.check_bounces(contacts, addresses_gone, since)
    return checked, outreach.outbox(checked, jobs, sender, max_send)
