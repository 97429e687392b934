import datetime as dt

from pyspark.sql import functions as F

from rolecall.operators import outreach, reconcile

SCHEMA = (
    "job_key string, contact_rank int, name string, candidates array<string>, email_tried array<string>,"
    " email_sent_at timestamp, email_sent_to string, email_bounced boolean"
)
T0 = dt.datetime(2024, 1, 1)


def contacts(spark):
    two = ["a@x.com", "b@x.com"]
    return spark.createDataFrame(
        [
            ("j", 1, "No Address", [], [], None, None, None),
            ("j", 2, "Fresh One", two, [], None, None, None),
            ("j", 3, "Pending Two", two, ["a@x.com"], T0, "a@x.com", None),
            ("j", 4, "Delivered Three", two, ["a@x.com"], T0, "a@x.com", False),
            ("j", 5, "Bounced Four", two, ["a@x.com"], T0, "A@x.com", True),
            ("j", 6, "Exhausted Five", two, ["a@x.com", "b@x.com"], T0, "b@x.com", True),
            ("j", 7, "Repeat Six", ["a@x.com", "a@x.com"], ["a@x.com"], T0, "a@x.com", True),
            ("j", 8, "Solo", ["s@x.com"], [], None, None, None),
            ("j", 9, "Nine Last", two, [], None, None, None),
            ("k", 1, "Kay One", two, [], None, None, None),
            ("m", 1, "Em One", two, [], None, None, None),
        ],
        SCHEMA,
    )


def test_outbox(spark):
    postings = spark.createDataFrame(
        [("j", "Subject", "Hi there,\ntext\nBest,"), ("k", "Subject", ""), ("m", None, "body")],
        "job_key string, email_subject string, email_body string",
    )
    got = outreach.outbox(contacts(spark), postings, "Sam").orderBy("send_no").collect()
    assert [(r.contact_rank, r.send_no, r.to_address, r.attempt, r.attempt_label) for r in got] == [
        (2, 1, "a@x.com", 1, ""), (5, 2, "b@x.com", 2, "[retry 2/2]"), (8, 3, "s@x.com", 1, "")
    ]
    assert [r.body for r in got] == [
        "Hi Fresh,\ntext\nBest,\nSam", "Hi Bounced,\ntext\nBest,\nSam", "Hi there,\ntext\nBest,\nSam"
    ]
    plan = outreach.send_plan(contacts(spark), 100)
    assert plan.filter(F.array_contains("email_tried", F.col("to_address"))).count() == 0
    assert {r.contact_rank for r in plan.filter("job_key = 'j'").collect()} == {2, 5, 8, 9}


def test_summary_and_reports(spark):
    row = outreach.outreach_summary(contacts(spark)).filter("job_key = 'j'").collect()[0]
    assert (row.total, row.with_email, row.already_sent, row.bounced, row.eligible, row.pending) == (9, 8, 5, 3, 4, 1)
    labels = {r.contact_rank: r.delivery for r in outreach.delivery_labels(contacts(spark)).collect()}
    assert labels == {3: "pending", 4: "delivered", 5: "bounced", 6: "bounced", 7: "bounced"}
    steps = {r.contact_rank: r.next_step for r in outreach.next_pattern_report(contacts(spark)).collect()}
    assert steps == {5: "b@x.com", 6: "exhausted", 7: "exhausted"}


def test_receipts(spark):
    later = T0 + dt.timedelta(days=1)
    receipts = spark.createDataFrame(
        [("j", 2, later, "a@x.com"), ("j", 5, later, "b@x.com"), ("j", 5, T0, "old@x.com"), ("z", 1, T0, "q@x.com")],
        "job_key string, contact_rank int, sent_at timestamp, sent_to string",
    )
    got = {(r.job_key, r.contact_rank): r for r in outreach.apply_receipts(contacts(spark), receipts).collect()}
    assert len(got) == 11
    assert (got["j", 2].email_tried, got["j", 2].email_sent_to, got["j", 2].email_bounced) == (["a@x.com"], "a@x.com", None)
    assert (got["j", 5].email_tried, got["j", 5].email_bounced) == (["a@x.com", "b@x.com"], None)
    assert (got["j", 6].email_tried, got["j", 6].email_bounced) == (["a@x.com", "b@x.com"], True)


def test_replace_contacts(spark):
    new = contacts(spark).filter("job_key = 'j' AND contact_rank < 3").withColumn("name", F.lit("New"))
    got = outreach.replace_contacts(contacts(spark), new).collect()
    assert sorted((r.job_key, r.contact_rank, r.name) for r in got) == [
        ("j", 1, "New"), ("j", 2, "New"), ("k", 1, "Kay One"), ("m", 1, "Em One")
    ]


def notices(spark):
    def h(*pairs):
        return [{"name": n, "value": v} for n, v in pairs]

    rows = [
        (1, T0, "Mailer-Daemon <MAILER-DAEMON@g.com>", h(("X-Failed-Recipients", " A@X.com "), ("To", "me@x.com"))),
        (2, T0, "postmaster@x.com", h(("To", "Bob <B@x.com>"))),
        (3, T0, "postmaster@x.com", h(("to", "first@x.com"), ("TO", "last@x.com"))),
        (4, T0, "postmaster@x.com", h(("Subject", "none"))),
        (5, T0, "friend@x.com", h(("To", "c@x.com"))),
        (6, T0, "postmaster@x.com", h(("x-failed-recipients", "  "), ("to", "d@x.com"))),
        (7, T0 - dt.timedelta(minutes=30), "postmaster@x.com", h(("to", "edge@x.com"))),
        (8, T0 - dt.timedelta(minutes=31), "postmaster@x.com", h(("to", "late@x.com"))),
        (9, T0, "postmaster@x.com", h(("to", "< e@x.com >>"))),
        (10, T0, "postmaster@x.com", []),
    ]
    return spark.createDataFrame(
        rows, "message_id bigint, received_at timestamp, sender string, headers array<struct<name:string,value:string>>"
    )


def test_notices(spark):
    kept = reconcile.bounce_notices(notices(spark))
    assert {r.message_id: r.address for r in kept.collect()} == {
        1: "a@x.com", 2: "b@x.com", 3: "last@x.com", 7: "edge@x.com", 8: "late@x.com", 9: "e@x.com"
    }
    since = reconcile.cutoff(F.lit(T0), 30)
    assert {r.address for r in reconcile.bounced_addresses(kept, since).collect()} == {
        "a@x.com", "b@x.com", "last@x.com", "edge@x.com", "e@x.com"
    }
    assert [r.message_id for r in reconcile.newest_notices(kept, 2).collect()] == [1, 2]


def test_check_bounces(spark):
    cutoff = T0 - dt.timedelta(minutes=30)
    old = cutoff - dt.timedelta(seconds=1)
    rows = [
        ("j", 1, "A@x.com", T0, None, True), ("j", 2, "A@x.com", cutoff, False, True), ("j", 3, "a@x.com", old, None, None),
        ("j", 4, "z@x.com", T0, None, False), ("j", 5, "z@x.com", T0, True, True), ("j", 6, "z@x.com", T0, False, False),
        ("j", 7, "a@x.com", None, None, True), ("j", 8, None, T0, None, None), ("j", 9, "", T0, None, None),
        ("j", 10, "z@x.com", old, True, True),
    ]
    df = spark.createDataFrame(
        [r[:5] for r in rows],
        "job_key string, contact_rank int, email_sent_to string, email_sent_at timestamp, email_bounced boolean",
    )
    gone = spark.createDataFrame([("a@x.com", 3)], "address string, notices bigint")
    got = reconcile.check_bounces(df, gone, reconcile.cutoff(F.lit(T0), 30))
    assert {r.contact_rank: r.email_bounced for r in got.collect()} == {r[1]: r[5] for r in rows}
