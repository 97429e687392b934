import datetime as dt
import os
import random

from pyspark.sql import functions as F

from rolecall.session import work_path
from rolecall.streaming import ingest, reconcile, retries

T0 = dt.datetime(2024, 1, 1)
DEAD = "send_id bigint, address string, at timestamp"


def drop_last_commit(checkpoint):
    """As if the driver was lost after the work of the last batch, before it was noted."""
    commits = os.path.join(checkpoint, "commits")
    last = max((int(n) for n in os.listdir(commits) if n.isdigit()))
    os.remove(os.path.join(commits, str(last)))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_append_once(spark):
    source, target, progress = (work_path(spark, n) for n in ("src", "dst", "chk"))

    def add(rows):
        spark.createDataFrame(rows, "k string, n int").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("k string, n int").parquet(source)
        ingest.append_once(stream, target, ["k"], ["n"], progress).awaitTermination()
        return sorted((r.k, r.n) for r in ingest.stored_rows(spark, target).collect())

    add([("a", 2), ("a", 1), ("b", 5)])
    assert run() == [("a", 1), ("b", 5)]
    add([("a", 0), ("c", 3), ("c", 4)])
    assert run() == [("a", 1), ("b", 5), ("c", 3)]
    assert run() == [("a", 1), ("b", 5), ("c", 3)]
    drop_last_commit(progress)
    assert run() == [("a", 1), ("b", 5), ("c", 3)]


def test_stream_table_takes_files_and_folders(spark, sf_dir):
    one = ingest.stream_table(spark, f"{sf_dir}/events.parquet")
    assert one.isStreaming and "event_id" in one.columns


def test_send_outcomes_against_brute_force(spark):
    rng = random.Random(19)
    wait, span = 600, 40_000
    # one address takes a third of all sends and notices
    address = lambda: "hot" if rng.random() < 0.34 else f"u{rng.randrange(30)}"
    sends = [(i, address(), T0 + dt.timedelta(seconds=rng.randrange(span))) for i in range(1500)]
    notices = [(address(), T0 + dt.timedelta(seconds=rng.randrange(span))) for _ in range(400)]
    notices += [(a, at + dt.timedelta(seconds=rng.choice([0, wait, wait + 1, -1]))) for _, a, at in sends[:200]]
    end = T0 + dt.timedelta(days=3)  # a late row on both sides closes every window before it
    src_s, src_n = work_path(spark, "s"), work_path(spark, "n")
    spark.createDataFrame(sends + [(-1, "end", end)], DEAD).repartition(3).write.parquet(src_s)
    spark.createDataFrame(notices + [("end2", end)], "address string, at timestamp").repartition(3).write.parquet(src_n)
    out = reconcile.send_outcomes(
        spark.readStream.schema(DEAD).parquet(src_s),
        spark.readStream.schema("address string, at timestamp").parquet(src_n),
        wait, "1 hour",
    )
    target = work_path(spark, "o")
    reconcile.store_stream(out, target, work_path(spark, "c")).awaitTermination()
    got = {r.send_id: r.outcome for r in spark.read.parquet(target).collect()}
    expected = {}
    for send_id, who, at in sends:
        answered = any(a == who and at <= t <= at + dt.timedelta(seconds=wait) for a, t in notices)
        expected[send_id] = "bounced" if answered else "delivered"
    assert got == expected


def test_retry_states(spark):
    rows = [
        (1, 1, "send", 0), (1, 1, "bounce", 5), (1, 2, "send", 10),  # second attempt open
        (2, 1, "send", 0),  # delivered
        (3, 1, "send", 0), (3, 1, "bounce", 5),  # retry
        (4, 1, "bounce", 1), (4, 1, "send", 0), (4, 2, "send", 2), (4, 2, "bounce", 3),  # exhausted
        (5, 1, "bounce", 1),  # never sent
        (2, 1, "send", 90),  # a replayed send does not reopen
    ]
    events = [(c, a, k, T0 + dt.timedelta(minutes=m)) for c, a, k, m in rows]
    schema = "contact_key int, attempt int, kind string, at timestamp"
    source, target, progress = (work_path(spark, n) for n in ("src", "dst", "chk"))
    for part in (events[:6], events[6:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        reconcile.attempt_states(stream, target, progress).awaitTermination()
    drop_last_commit(progress)
    reconcile.attempt_states(spark.readStream.schema(schema).parquet(source), target, progress).awaitTermination()
    as_of = F.lit(T0 + dt.timedelta(minutes=14))
    got = reconcile.contact_states(reconcile.latest_attempts(spark, target), F.lit(2), as_of, 300)
    assert {(r.contact_key, r.tried, r.bounces, r.state) for r in got.collect()} == {
        (1, 2, 1, "pending"), (2, 1, 0, "delivered"), (3, 1, 1, "retry"), (4, 2, 2, "exhausted")
    }


def test_every_send_has_one_row(spark):
    """Outcomes given out and sends that still wait make up all sends, at every stop of the stream."""
    wait = 600
    src_s, src_n, target, progress = (work_path(spark, n) for n in ("s", "n", "o", "c"))
    rng = random.Random(2)
    sends = [(i, f"u{rng.randrange(9)}", T0 + dt.timedelta(seconds=rng.randrange(60_000))) for i in range(400)]
    sends.sort(key=lambda r: r[2])
    notices = [(a, at + dt.timedelta(seconds=rng.choice([5, wait, wait + 1]))) for _, a, at in sends[::3]]
    for cut in (0, 1):
        for rows, schema, path in ((sends, DEAD, src_s), (notices, "address string, at timestamp", src_n)):
            half = rows[: len(rows) // 2] if cut == 0 else rows[len(rows) // 2 :]
            spark.createDataFrame(half, schema).coalesce(1).write.mode("append").parquet(path)
        out = reconcile.send_outcomes(
            spark.readStream.schema(DEAD).parquet(src_s), spark.readStream.schema("address string, at timestamp").parquet(src_n), wait, "1 hour"
        )
        reconcile.store_stream(out, target, progress).awaitTermination()
        given = spark.read.parquet(target)
        waiting = reconcile.open_sends(spark, progress, given)
        rows = given.unionByName(waiting).collect()
        seen = sends[: len(sends) // 2] if cut == 0 else sends
        assert sorted(r.send_id for r in rows) == sorted(s[0] for s in seen)
        assert {r.outcome for r in rows} == {"bounced", "delivered", "pending"}
        for r in rows:
            if r.outcome != "pending":
                answered = any(a == r.address and r.sent_at <= t <= r.sent_at + dt.timedelta(seconds=wait) for a, t in notices)
                assert r.outcome == ("bounced" if answered else "delivered")


RETRY = "contact_key int, attempt int, kind string, at timestamp"


def _retry_run(spark, batches, wait, keep, replay=False):
    """Emitted rows in order, and the contacts left in the state, of a stream fed batch by batch."""
    source, target, progress = (work_path(spark, n) for n in ("src", "dst", "chk"))
    for batch in batches:
        rows = [(c, a, k, T0 + dt.timedelta(seconds=s)) for c, a, k, s in batch]
        spark.createDataFrame(rows, RETRY).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RETRY).parquet(source)
        retries.store_retries(retries.retry_events(stream, 2, wait, keep, "10 seconds"), target, progress).awaitTermination()
        if replay:
            drop_last_commit(progress)
            stream = spark.readStream.schema(RETRY).parquet(source)
            retries.store_retries(retries.retry_events(stream, 2, wait, keep, "10 seconds"), target, progress).awaitTermination()
    found = sorted(retries.emitted(spark, target).collect(), key=lambda r: (r.contact_key, r.version))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", retries.ROCKS)
    state = spark.read.format("statestore").option("stateVarName", "contact").load(progress)
    held = {r.contact_key for r in state.select("key.contact_key").collect()}
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return [(r.contact_key, r.attempt, r.state, int((r.at - T0).total_seconds())) for r in found], held


def test_retry_events_are_emitted_when_they_happen(spark):
    batches = [
        [(1, 1, "send", 0), (2, 1, "send", 0), (3, 1, "bounce", 5), (4, 1, "send", 0), (4, 1, "send", 9)],
        [(1, 1, "bounce", 50), (3, 1, "send", 3), (9, 1, "send", 130)],  # the watermark goes to 120
        [(1, 2, "send", 125), (2, 1, "send", 131), (2, 1, "bounce", 132), (9, 1, "bounce", 140)],
        [(1, 2, "bounce", 225), (9, 2, "send", 240), (5, None, "send", 240), (5, 1, "view", 240)],
        [(9, 2, "other", 900), (8, 1, "send", 2000)],
    ]
    found, held = _retry_run(spark, batches, 100, 1000, replay=True)
    assert found == [
        (1, 1, "pending", 0), (1, 1, "bounced", 50), (1, 1, "retry", 50), (1, 2, "pending", 125), (1, 2, "bounced", 225), (1, 2, "exhausted", 225),
        (2, 1, "pending", 0), (2, 1, "delivered", 100),  # a send and a bounce after it was settled change nothing
        (3, 1, "pending", 3), (3, 1, "bounced", 5), (3, 1, "retry", 5),  # the bounce came in ahead of its send
        (4, 1, "pending", 0), (4, 1, "delivered", 100),
        (8, 1, "pending", 2000),
        (9, 1, "pending", 130), (9, 1, "bounced", 140), (9, 1, "retry", 140), (9, 2, "pending", 240), (9, 2, "delivered", 340),
    ]
    assert held == {8}  # all others were quiet for longer than ``keep``


def test_retry_events_against_a_fold(spark):
    """Any cut of ordered rows into batches gives what a fold over the rows by time gives; one contact has a third of them."""
    rng = random.Random(31)
    rows = sorted(
        ((7 if rng.random() < 0.34 else rng.randrange(12), rng.randrange(1, 3), rng.choice(["send", "bounce"]), rng.randrange(5000)) for _ in range(300)),
        key=lambda r: r[3],
    )
    expected = []
    last = rows[-1][3] - 10
    for key in sorted({r[:2] for r in rows}):
        sent = min((s for *k, kind, s in rows if tuple(k) == key and kind == "send"), default=None)
        bounce = min((s for *k, kind, s in rows if tuple(k) == key and kind == "bounce"), default=None)
        if sent is None:
            continue
        expected.append((*key, "pending", sent))
        if bounce is not None and bounce <= sent + 400:
            expected += [(*key, "bounced", bounce), (*key, "retry" if key[1] < 2 else "exhausted", bounce)]
        elif sent + 400 <= last:
            expected.append((*key, "delivered", sent + 400))
    for parts in (1, 3):
        size = -(-len(rows) // parts)
        found, _ = _retry_run(spark, [rows[i : i + size] for i in range(0, len(rows), size)], 400, 100_000)
        assert sorted(found) == sorted(expected)
