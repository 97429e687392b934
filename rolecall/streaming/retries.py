"""Retry state per contact, kept in a stream: what happens is emitted when it happens.

An attempt is pending once it was sent. A bounce no later than ``wait`` seconds after the send settles it as bounced, and
the contact goes to its next candidate (retry) or is exhausted; otherwise a timer at ``sent + wait`` settles it as
delivered. Times are event times, so a replay of the same rows gives the same result whatever the clock says.

Each contact holds its open attempts (first send, first bounce) and the numbers of its settled ones, which a repeated send
does not open again. A second timer, ``keep`` seconds after the last of a contact's rows, removes all of it. Rows of a batch
are cut down to one per task, contact and attempt before the shuffle, so a contact with a third of all rows moves at most as many
rows as it has attempts and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from rolecall.functions import constants as K
from rolecall.operators.skew import first_by
from rolecall.streaming.reconcile import store_stream

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COMBINED = "contact_key long, attempt int, sent long, bounced long, seen timestamp"
EMITTED = "contact_key long, attempt int, state string, at long, version long"
STATE = "attempts array<int>, sent array<long>, bounced array<long>, settled array<int>, last long, version long"
SECOND = 1_000_000
#: Stands for no time in the state's arrays.
NEVER = -(1 << 62)


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First send and first bounce per contact and attempt, batch by batch; ``seen``: the latest time among them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).group_by(["contact_key", "attempt"], use_threads=False).aggregate(
            [("sent", "min"), ("bounced", "min"), ("at", "max")]
        )
        named = rows.select(["contact_key", "attempt", "sent_min", "bounced_min", "at_max"]).rename_columns(
            ["contact_key", "attempt", "sent", "bounced", "seen"]
        )
        yield from named.to_batches()


class RetryProcessor(StatefulProcessor):
    """State of one contact. ``candidates``: addresses it has; times are microseconds."""

    def __init__(self, candidates: int, wait: int, keep: int):
        self.candidates, self.wait, self.keep = candidates, wait * SECOND, keep * SECOND

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("contact", STATE)

    def _load(self) -> tuple[dict[int, list[int]], set[int], int, int]:
        if not self.state.exists():
            return {}, set(), NEVER, 0
        attempts, sent, bounced, settled, last, version = self.state.get()
        held = {a: [s, b] for a, s, b in zip(attempts, sent, bounced, strict=True)}
        return held, set(settled), last, version

    def _save(self, held: dict[int, list[int]], settled: set[int], last: int, version: int) -> None:
        order = sorted(held)
        self.state.update((order, [held[a][0] for a in order], [held[a][1] for a in order], sorted(settled), last, version))

    def _timer(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))  # milliseconds, never early

    def _row(self, key, attempt: int, state: str, at: int, version: int) -> Row:
        return Row(contact_key=key[0], attempt=attempt, state=state, at=at, version=version)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, settled, last, version = self._load()
        changed, opened = set(), set()
        for row in rows:
            last = max(last, *(t for t in (row.sent, row.bounced) if t is not None))
            if row.attempt in settled:
                continue
            times = held.setdefault(row.attempt, [NEVER, NEVER])
            for place, at in ((0, row.sent), (1, row.bounced)):
                if at is not None and (times[place] == NEVER or at < times[place]):
                    times[place] = at
                    changed.add(row.attempt)
                    if place == 0:
                        opened.add(row.attempt)
        for attempt in sorted(changed):
            sent, bounced = held[attempt]
            if sent == NEVER:
                continue  # a bounce ahead of its send waits for it
            found = [("pending", sent)] if attempt in opened else []
            if bounced != NEVER and bounced <= sent + self.wait:
                found += [("bounced", bounced), ("retry" if attempt < self.candidates else "exhausted", bounced)]
                settled.add(attempt)
                del held[attempt]
            else:
                self._timer(sent + self.wait)
            for state, at in found:
                version += 1
                yield self._row(key, attempt, state, at, version)
        self._timer(last + self.keep)
        self._save(held, settled, last, version)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, settled, last, version = self._load()
        if last == NEVER:
            return
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for attempt, (sent, _) in sorted(held.items()):
            if sent != NEVER and sent + self.wait <= now:
                version += 1
                settled.add(attempt)
                del held[attempt]
                yield self._row(key, attempt, "delivered", sent + self.wait, version)
        if last + self.keep <= now:
            self.state.clear()
        else:
            self._save(held, settled, last, version)

    def close(self) -> None:
        pass


def retry_events(
    stream: DataFrame, candidates: int, wait: int = K.WAIT_SECONDS, keep: int = 30 * 86_400, delay: str = "1 hour"
) -> DataFrame:
    """Stream of (contact_key, attempt, state, at, version) from a stream of contact_key, attempt, kind and at.

    kind: 'send' or 'bounce'; other rows and rows without a key, attempt or time are left out. ``version`` counts a contact's rows
    in the order they were emitted. Rows later than ``delay`` are dropped. ``keep`` is at least ``wait``.
    """
    if keep < wait:
        raise ValueError("keep must not be less than wait")

    def time_of(kind: str):
        return F.when(F.col("kind") == kind, F.unix_micros("at"))

    known = stream.filter(F.col("kind").isin("send", "bounce")).dropna(subset=["contact_key", "attempt", "at"])
    rows = known.select(
        F.col("contact_key").cast("long").alias("contact_key"), F.col("attempt").cast("int").alias("attempt"),
        time_of("send").alias("sent"), time_of("bounce").alias("bounced"), F.col("at").cast("timestamp").alias("at"),
    ).mapInArrow(combined, COMBINED)
    return rows.withWatermark("seen", delay).groupBy("contact_key").transformWithState(
        RetryProcessor(candidates, wait, keep), EMITTED, "Append", "EventTime"
    )


def store_retries(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append ``retry_events`` to a table, exactly once. Its state store is RocksDB, which timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    spark = events.sparkSession
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        return store_stream(events, target, checkpoint)
    finally:
        spark.conf.set(name, before)


def emitted(spark: SparkSession, target: str) -> DataFrame:
    """Stored retry events, ``at`` as a time."""
    return spark.read.schema(EMITTED).parquet(target).withColumn("at", F.timestamp_micros("at"))


def attempt_outcomes(events: DataFrame) -> DataFrame:
    """Where each attempt stands: the last thing emitted for it. Every attempt that was sent has one row."""
    return first_by(events, ["contact_key", "attempt"], [F.desc("version")]).drop("version")
