"""Delivery notices against sends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import text as T
from rolecall.functions.stage import settled
from rolecall.operators.skew import lookup_join


def cutoff(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def failed_recipient(headers: str = "headers") -> Column:
    """Address a notice is about: the failed-recipients header, else To; '' when blank."""

    def last(name: str) -> Column:
        same = F.filter(headers, lambda h: F.lower(h["name"]) == name)
        return T.strip(F.lower(F.try_element_at(same, F.lit(-1))["value"]))

    to = last("to")
    inner = F.regexp_replace(F.split_part(to, F.lit("<"), F.lit(2)), r">+\z", "")
    bare = F.when(to.contains("<") & to.contains(">"), T.strip(inner)).otherwise(to)
    return F.coalesce(last("x-failed-recipients"), bare)


def bounce_notices(messages: DataFrame) -> DataFrame:
    """Messages a mail system sent about a failed delivery, with the address concerned."""
    system = F.col("sender").rlike("(?i)mailer-daemon|postmaster")
    named = settled(messages.filter(system).withColumn("address", failed_recipient()), "address")
    return named.filter(F.coalesce("address", F.lit("")) != "")


def newest_notices(messages: DataFrame, n: int = K.NOTICE_PAGE) -> DataFrame:
    """One mailbox page: the newest ``n`` notices. A top-k, used only where asked for."""
    return messages.orderBy(F.desc("received_at"), "message_id").limit(n)


def bounced_addresses(notices: DataFrame, since: Column) -> DataFrame:
    """Distinct addresses with a notice since the cutoff, with their notice count."""
    return (
        notices.filter(F.col("received_at") >= since)
        .groupBy("address")
        .agg(F.count(F.lit(1)).alias("notices"))
    )


def check_bounces(contacts: DataFrame, addresses: DataFrame, since: Column) -> DataFrame:
    """Bounce state after a poll.

    Contacts last written to before the cutoff stay as they are. In the window a notice
    sets True; without one an open state becomes False. True never turns back.
    """
    known = addresses.select(F.col("address").alias("_address"), F.lit(True).alias("_hit"))
    keyed = contacts.withColumn("_address", F.lower("email_sent_to"))
    in_window = (F.coalesce("email_sent_to", F.lit("")) != "") & (
        F.col("email_sent_at").isNull() | (F.col("email_sent_at") >= since)
    )
    state = (
        F.when(~in_window, F.col("email_bounced"))
        .when(F.col("_hit"), F.lit(True))
        .otherwise(F.coalesce("email_bounced", F.lit(False)))
    )
    joined = lookup_join(keyed, known, ["_address"], ["job_key", "contact_rank"])
    return joined.withColumn("email_bounced", state).drop("_address", "_hit")
