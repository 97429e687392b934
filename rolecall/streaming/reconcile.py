"""Delivery outcomes and retry state from streams of sends and notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolecall.functions import constants as K
from rolecall.operators.skew import first_by
from rolecall.streaming.ingest import fitting_state, run_available

SALTS = 8


def _spans(at: str, wait: int) -> Column:
    """Window pairs: each spans two waits and starts on a multiple of one."""
    return F.window(at, f"{2 * wait} seconds", f"{wait} seconds")


def _in_first_half(wait: int) -> Column:
    return F.col("at") < F.col("span.start") + F.expr(f"INTERVAL '{wait}' SECOND")


def send_outcomes(
    sends: DataFrame,
    notices: DataFrame,
    wait: int = K.WAIT_SECONDS,
    delay: str = "1 hour",
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Outcome per send: did a notice for its address arrive within ``wait`` seconds of it?

    sends: send_id, address, at. notices: address, at. A send's own window and the next one
    hold every notice that can answer it. Of those only the last notice of the first half
    and the first of the second half decide, so notices are aggregated per address and
    window pair (combining before the shuffle) and a send meets one row at most. Sends to
    a busy address are spread over ``salts`` copies of that row, or over as many as ``hot``
    says (address, _salts; see ``skew.hot_keys``), all others then over one. Notices later than
    ``delay`` are dropped; a send is given out once its windows are over. ``open_sends`` gives those
    that are not.
    """

    def salted(rows: DataFrame) -> tuple[DataFrame, Column]:
        if hot is None:
            return rows, F.lit(salts)
        return rows.join(F.broadcast(hot.select("address", "_salts")), "address", "left"), F.coalesce("_salts", F.lit(1))

    early = _in_first_half(wait)
    answers = (
        notices.select("address", "at")
        .withWatermark("at", delay)
        .withColumn("span", _spans("at", wait))
        .groupBy("span", "address")
        .agg(
            F.max(F.when(early, F.col("at"))).alias("last_early"),
            F.min(F.when(~early, F.col("at"))).alias("first_late"),
        )
    )
    answers, most = salted(answers)
    answers = answers.withColumn("salt", F.explode(F.sequence(F.lit(0), most - 1))).drop("_salts")
    waiting = (
        sends.select("send_id", "address", "at")
        .withWatermark("at", delay)
        .withColumn("span", _spans("at", wait))
        .filter(early)
        # the join's event time is the window, so the send's own time becomes a plain column
        .withColumn("sent_at", F.timestamp_micros(F.unix_micros("at")))
        .drop("at")
    )
    waiting, most = salted(waiting)
    waiting = waiting.withColumn("salt", F.pmod(F.xxhash64("send_id"), most).cast("int")).drop("_salts")
    in_time = (F.col("last_early") >= F.col("sent_at")) | (
        F.col("first_late") <= F.col("sent_at") + F.expr(f"INTERVAL '{wait}' SECOND")
    )
    return (
        waiting.join(answers, ["span", "address", "salt"], "left")
        .withColumn("outcome", F.when(in_time, "bounced").otherwise("delivered"))
        .select("send_id", "address", "sent_at", "outcome")
    )


def open_sends(spark: SparkSession, checkpoint: str, stored: DataFrame) -> DataFrame:
    """Sends that wait in the stopped stream's state, as send_id, address, sent_at, outcome 'pending'.

    The join keeps a send until its windows are over, so its state and ``stored`` (what the stream has given out)
    together hold every send. Only the state is read, and of ``stored`` what is no older than it. A send to no address is
    not matched with one, and waits like any other.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    join = operators.filter(F.col("operatorName") == "symmetricHashJoin").select("operatorId").first()[0]
    reader = spark.read.format("statestore").option("joinSide", "left").option("operatorId", join)
    held = reader.load(checkpoint).select("value.send_id", "value.address", "value.sent_at")
    since = held.agg(F.min("sent_at")).first()[0]
    given = stored.filter(F.lit(False) if since is None else F.col("sent_at") >= F.lit(since)).select("send_id").distinct()
    # a matched send was given out, but stays in the state as long as the others
    return held.join(given, "send_id", "left_anti").withColumn("outcome", F.lit("pending"))


def store_stream(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once through the sink's own log."""
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
    )
    with fitting_state(stream.sparkSession):
        return writer.start(target)


def attempt_states(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Running state of every (contact, attempt): first send, and whether it bounced.

    stream: contact_key, attempt, kind ('send' or 'bounce'), at. The state combines in any
    order and before the shuffle. Each batch writes the states it changed to its own folder.
    """
    states = stream.groupBy("contact_key", "attempt").agg(
        F.min(F.when(F.col("kind") == "send", F.col("at"))).alias("sent_at"),
        F.max(F.col("kind") == "bounce").alias("bounced"),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return run_available(states, checkpoint, store, mode="update")


def latest_attempts(spark: SparkSession, target: str) -> DataFrame:
    states = spark.read.parquet(target)
    return first_by(states, ["contact_key", "attempt"], [F.desc("batch_id")]).drop("batch_id")


def contact_states(
    attempts: DataFrame, candidates: Column, as_of: Column, wait: int = K.WAIT_SECONDS
) -> DataFrame:
    """delivered, pending, retry or exhausted per contact.

    An attempt is delivered when ``wait`` seconds passed without a bounce, else pending. A
    contact whose sends all bounced goes to its next candidate until none is left.
    """
    over = F.col("sent_at") + F.expr(f"INTERVAL '{wait}' SECOND") <= as_of
    sent = attempts.filter(F.col("sent_at").isNotNull())
    totals = sent.groupBy("contact_key").agg(
        F.count(F.lit(1)).alias("tried"),
        F.count_if("bounced").alias("bounces"),
        F.max(~F.col("bounced") & over).alias("_delivered"),
        F.max(~F.col("bounced") & ~over).alias("_pending"),
    )
    state = (
        F.when(F.col("_delivered"), "delivered")
        .when(F.col("_pending"), "pending")
        .when(F.col("tried") < candidates, "retry")
        .otherwise("exhausted")
    )
    return totals.withColumn("state", state).drop("_delivered", "_pending")
