"""Who may be written to next, the outbox, and the state after sending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.functions import text as T
from rolecall.operators.postings import has_draft
from rolecall.operators.skew import first_by, lookup_join, top_by


def untried() -> Column:
    """Candidates not written to yet, in order (repeats kept)."""
    return F.filter("candidates", lambda c: ~F.array_contains("email_tried", c))


def next_address() -> Column:
    return F.try_element_at(untried(), F.lit(1))


def bounced() -> Column:
    """True only for a known bounce; pending and delivered are not."""
    return F.col("email_bounced").eqNullSafe(True)


def sendable() -> Column:
    # looks no further than the first one
    any_untried = F.exists("candidates", lambda c: ~F.array_contains("email_tried", c))
    return (F.col("email_sent_at").isNull() | bounced()) & any_untried


def attempt_label() -> Column:
    """'[retry n/total]' once an address was tried, else ''."""
    tried = F.size("email_tried")
    label = F.format_string("[retry %d/%d]", tried + 1, F.size("candidates"))
    return F.when(tried > 0, label).otherwise("")


def send_plan(contacts: DataFrame, max_send: int = K.MAX_SEND) -> DataFrame:
    """First ``max_send`` sendable contacts of each posting in stored order."""
    ready = contacts.filter(sendable())
    return top_by(ready, ["job_key"], ["contact_rank"], max_send, "send_no").withColumn(
        "to_address", next_address()
    )


def outbox(
    contacts: DataFrame, postings: DataFrame, sender: str = "", max_send: int = K.MAX_SEND
) -> DataFrame:
    """Messages to send: capped sendable contacts of postings that have a draft."""
    drafts = postings.filter(has_draft()).select("job_key", "email_subject", "email_body")
    # the cap leaves few rows per posting, so no posting is hot in this join
    planned = N.with_first_last(send_plan(contacts, max_send), "name").join(drafts, "job_key")
    return (
        planned.withColumn("from_name", F.lit(sender))
        .withColumn(
            "body", T.personal_body(F.col("email_body"), F.col("first"), F.col("from_name"))
        )
        .withColumn("attempt", F.size("email_tried") + 1)
        .withColumn("attempt_label", attempt_label())
        .select(
            "job_key", "contact_rank", "send_no", "name", "to_address",
            F.col("email_subject").alias("subject"), "body", "from_name", "attempt", "attempt_label",
        )
    )


def apply_receipts(contacts: DataFrame, receipts: DataFrame) -> DataFrame:
    """Contacts after sending: last send, tried list grown, bounce state open again.

    Receipts are (job_key, contact_rank, sent_at, sent_to); of several for one contact the
    latest counts, since a run writes to a contact once.
    """
    key = ["job_key", "contact_rank"]
    last = first_by(
        receipts.select(*key, F.col("sent_at").alias("_at"), F.col("sent_to").alias("_to")),
        key,
        [F.desc("_at"), "_to"],
    )
    sent = F.col("_to").isNotNull()
    return (
        contacts.join(last, key, "left")
        .withColumn("email_sent_at", F.coalesce("_at", "email_sent_at"))
        .withColumn("email_sent_to", F.coalesce("_to", "email_sent_to"))
        .withColumn(
            "email_tried",
            F.when(sent, F.array_append("email_tried", F.col("_to"))).otherwise(F.col("email_tried")),
        )
        .withColumn("email_bounced", F.when(~sent, F.col("email_bounced")))
        .drop("_at", "_to")
    )


def replace_contacts(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Contact rows after postings in ``updates`` had their whole list replaced.

    Rows stay flat, so a posting with very many contacts is never gathered into one record.
    """
    replaced = updates.select("job_key").distinct().withColumn("_new", F.lit(True))
    kept = lookup_join(stored, replaced, ["job_key"], ["contact_rank"]).filter(F.col("_new").isNull())
    return kept.drop("_new").unionByName(updates)


def delivery_labels(contacts: DataFrame) -> DataFrame:
    """bounced, pending or delivered for every contact written to."""
    label = (
        F.when(F.col("email_bounced").isNull(), "pending")
        .when(F.col("email_bounced"), "bounced")
        .otherwise("delivered")
    )
    sent = F.coalesce("email_sent_to", F.lit("")) != ""
    return contacts.filter(sent).withColumn("delivery", label)


def next_pattern_report(contacts: DataFrame) -> DataFrame:
    """Bounced contacts with the address to try next, or 'exhausted'."""
    return contacts.filter(bounced()).withColumn(
        "next_step", F.coalesce(next_address(), F.lit("exhausted"))
    )


def outreach_summary(contacts: DataFrame) -> DataFrame:
    """Counts per posting shown before sending."""
    return contacts.groupBy("job_key").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size("candidates") > 0).alias("with_email"),
        F.count_if(F.col("email_sent_at").isNotNull()).alias("already_sent"),
        F.count_if(bounced()).alias("bounced"),
        F.count_if(sendable()).alias("eligible"),
        F.count_if(F.col("email_sent_at").isNotNull() & F.col("email_bounced").isNull()).alias("pending"),
    )
