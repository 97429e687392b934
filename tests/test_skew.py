import random

from pyspark.sql import functions as F

from rolecall.operators import skew


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}") for i in range(4000)]
    rows += [(i, None) for i in range(4000, 4200)] + [(i, "missing") for i in range(4200, 4300)]
    return spark.createDataFrame(rows, "id int, k string")


def test_lookup_join_keeps_every_row(spark):
    fact = facts(spark)
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(250)], "k string, v int")
    for how in ("left", "inner"):
        got = sorted(map(str, skew.lookup_join(fact, dim, ["k"], ["id"], how).select("id", "k", "v").collect()))
        assert got == sorted(map(str, fact.join(dim, "k", how).select("id", "k", "v").collect()))


def test_numbered(spark):
    rng = random.Random(2)
    rows = [("hot", n) for n in rng.sample(range(-500, 5000), 1500)] + [(f"k{i % 9}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    got = {(r.k, r.n): r.no for r in skew.numbered(df, ["k"], "n", "no", width=37).collect()}
    expected = {}
    for k in {k for k, _ in rows}:
        expected |= {(k, n): at + 1 for at, n in enumerate(sorted(n for key, n in rows if key == k))}
    assert got == expected


def test_hot_keys_are_few_and_spread(spark):
    fact = facts(spark)
    hot = {r.k: r["_salts"] for r in skew.hot_keys(fact, ["k"]).collect()}
    assert set(hot) == {"hot", "missing", None} and hot["missing"] == 2 and hot["hot"] > 20
    assert {r.k: r["_salts"] for r in skew.hot_keys(fact, ["k"], 5).collect()} == {"hot": 2}
    same = spark.range(2000).select(F.lit("one").alias("k"), F.col("id"))
    joined = skew.lookup_join(same, spark.createDataFrame([("one", 1)], "k string, v int"), ["k"], ["id"])
    assert joined.filter("v = 1").count() == 2000


def test_top_by_cuts_before_the_shuffle(spark):
    fact = facts(spark).repartition(4)
    top = skew.top_by(fact, ["k"], ["id"], 2)
    text = plan_of(top)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    got = {}
    for r in top.collect():
        got.setdefault(r.k, []).append(r.id)
    expected = {}
    for r in sorted(facts(spark).collect(), key=lambda r: r.id):
        expected.setdefault(r.k, [])
        if len(expected[r.k]) < 2:
            expected[r.k].append(r.id)
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_numbered_moves_rows_once_where_no_key_is_long(spark):
    rows = [(f"k{i % 7}", i * 50_000 % 99_991) for i in range(300)] + [(None, 1), ("k1", None)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    got = skew.numbered(df, ["k"], "n", "no")
    assert got.columns == ["k", "n", "no"] and plan_of(got).count("Exchange hashpartitioning") == 1
    # grouping within the key needs no second move
    assert plan_of(got.groupBy("k", F.floor(F.col("no") / 10)).count()).count("Exchange hashpartitioning") == 1
    values = {}
    for k, n in rows:
        if k is not None and n is not None:
            values.setdefault(k, []).append(n)
    assert sorted(map(tuple, got.collect())) == sorted((k, n, at + 1) for k, found in values.items() for at, n in enumerate(sorted(found)))


def test_numbered_cuts_only_long_keys(spark):
    rows = [("long", n * 3) for n in range(-40, 60)] + [("short", n * 1000) for n in range(10)] + [("long", None), (None, 4)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    assert [r.k for r in skew.long_keys(df, ["k"], 37).collect()] == ["long"]
    expected = sorted([("long", n * 3, n + 41) for n in range(-40, 60)] + [("short", n * 1000, n + 1) for n in range(10)])
    both = spark.createDataFrame([("long",), ("short",), ("none",)], "k string")
    for known in (None, skew.long_keys(df, ["k"], 37), both):
        got = skew.numbered(df, ["k"], "n", "no", width=37, long=known)
        assert sorted(map(tuple, got.collect())) == expected


def test_hot_keys_count_groups_once(spark):
    assert plan_of(skew.hot_keys(facts(spark), ["k"])).count("Exchange hashpartitioning") == 1
