"""Ordered operators against brute force, with one entity holding most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import ranking as R
from tidewater.operators import timecells as TC
from tidewater.operators.asof import asof_join, latest_features
from tidewater.operators.sessions import item_transitions, session_facts, tag_sessions


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    rows, at = [], 1_700_000_000_000_000
    for i in range(600):
        at += rng.choice([1, 40, 900, 2400]) * 1_000_000 + rng.randrange(1_000_000)
        user = "hot" if rng.random() < 0.5 else f"u{rng.randrange(6)}"
        rows.append((i, user, at, rng.choice(["clicks", "cart", "purchase", "search"]), rng.randrange(8) if rng.random() < 0.8 else None))
    df = spark.createDataFrame(rows, "event_id long, user_id string, at long, event_type string, product_id long")
    return df.select("event_id", "user_id", F.timestamp_micros("at").alias("event_ts"), "event_type", "product_id", F.lit(None).cast("string").alias("session_id")).cache()


def same(a, b):
    left, right = (sorted(map(tuple, d.select(*sorted(a.columns)).collect()), key=repr) for d in (a, b))
    assert left == right


def by_user():
    return Window.partitionBy("user_id").orderBy("event_ts", "event_id")


@pytest.mark.parametrize("cell", [60, 3600, 10**9])
def test_prior_totals(spark, events, cell):
    got = TC.with_prior_totals(events, "user_id", "event_ts", ["event_ts", "event_id"], {"n": F.lit(1), "s": F.col("event_id")}, cell)
    w = by_user().rowsBetween(Window.unboundedPreceding, -1)
    want = events.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("s", F.coalesce(F.sum("event_id").over(w), F.lit(0)))
    same(got.select("event_id", "n", "s"), want.select("event_id", "n", "s"))


@pytest.mark.parametrize("after", [False, True])
def test_neighbour(spark, events, after):
    got = TC.with_neighbour(events, "user_id", "event_ts", ["event_ts", "event_id"], ["event_id"], "nb", after=after, cell_seconds=300)
    shift = F.lead if after else F.lag
    want = events.withColumn("nb", shift("event_id").over(by_user()))
    same(got.select("event_id", F.col("nb.event_id").alias("nb")), want.select("event_id", "nb"))


def test_trailing_count(spark, events):
    got = TC.with_trailing_count(events, "user_id", "event_ts", 3600, "n")
    w = Window.partitionBy("user_id").orderBy(F.unix_micros("event_ts")).rangeBetween(-3_600_000_000, 0)
    same(got.select("event_id", "n"), events.withColumn("n", F.count(F.lit(1)).over(w)).select("event_id", "n"))


@pytest.mark.parametrize("tiles", [1, 5, 7, 1000])
def test_ntile(spark, events, tiles):
    order = [F.col("product_id").desc_nulls_last(), F.col("event_id")]
    got = R.with_ntile(events, tiles, order, "t")
    want = events.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    same(got.select("event_id", "t"), want.select("event_id", "t"))


def test_running_totals_and_percentile(spark, events):
    got = R.with_running_totals(events, [F.col("event_id")], {"s": F.col("event_id")})
    want = events.withColumn("s", F.sum("event_id").over(Window.orderBy("event_id")))
    same(got.select("event_id", "s"), want.select("event_id", "s"))
    for p in (0.0, 0.5, 0.99, 1.0):
        exact = events.agg(F.percentile("event_id", F.lit(p))).first()[0]
        assert R.exact_percentile(events, "event_id", p).first()["cut"] == pytest.approx(exact)


@pytest.mark.parametrize("gap", [30, 600])
def test_sessions(spark, events, gap):
    previous = F.lag("event_ts").over(by_user())
    whole = F.floor((F.unix_micros("event_ts") - F.unix_micros(previous)) / 60_000_000)
    flagged = events.withColumn("f", F.when(previous.isNull() | (whole > gap), 1).otherwise(0))
    want = flagged.withColumn("session_num", F.sum("f").over(by_user())).select("event_id", "session_num")
    same(tag_sessions(events, gap).select("event_id", "session_num"), want)
    with_items, totals = session_facts(events, gap), session_facts(events, gap, with_sequence=False)
    same(with_items.drop("product_sequence"), totals)
    assert totals.agg(F.sum("event_count")).first()[0] == events.count()
    w = Window.partitionBy("user_id", "session_num").orderBy("event_ts", "event_id")
    pairs = events.join(want, "event_id").where("product_id is not null").withColumn("next_item", F.lead("product_id").over(w)).where("next_item is not null")
    same(
        item_transitions(events, gap).select("user_id", "session_num", "item", "next_item"),
        pairs.select("user_id", "session_num", F.col("product_id").alias("item"), "next_item"),
    )


def test_session_gap_counts_whole_minutes(spark):
    rows = [(1, "u", "2024-01-01 00:00:00", None), (2, "u", "2024-01-01 00:30:59", "a"), (3, "u", "2024-01-01 01:01:59", "b")]
    df = spark.createDataFrame(rows, "event_id long, user_id string, t string, product_id string").select(
        "event_id", "user_id", F.to_timestamp("t").alias("event_ts"), F.lit("clicks").alias("event_type"), "product_id", F.lit(None).cast("string").alias("session_id")
    )
    out = session_facts(df).orderBy("session_start").collect()
    assert [r["event_count"] for r in out] == [2, 1]
    assert out[0]["product_sequence"] == [None, "a"]
    assert [r["session_id"] for r in out] == ["u_1", "u_2"]


@pytest.mark.parametrize("cell", [600, 86_400])
def test_asof(spark, events, cell):
    features = events.where("event_type = 'purchase'").select("user_id", F.col("event_ts").alias("ft"), F.col("event_id").alias("fid"))
    spine = events.where("event_type <> 'purchase'").select("event_id", "user_id", "event_ts")
    got = asof_join(spine, features, "user_id", "event_ts", "ft", ["fid"], ttl_seconds=7200, cell_seconds=cell).select("event_id", "fid")
    known = features.collect()
    want = []
    for r in spine.collect():
        best = max((f for f in known if f["user_id"] == r["user_id"] and f["ft"] <= r["event_ts"]), key=lambda f: f["ft"], default=None)
        ok = best is not None and (r["event_ts"] - best["ft"]).total_seconds() <= 7200
        want.append((r["event_id"], best["fid"] if ok else None))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_asof_borders(spark):
    def at(text):
        return F.to_timestamp(F.lit(text))

    spine = spark.range(1).select(F.lit("a").alias("e"), at("2024-01-09 00:00:00").alias("t"))
    old = spark.range(1).select(F.lit("a").alias("e"), at("2024-01-01 00:00:00").alias("ft"), F.lit(1).alias("x"))
    same_time = old.withColumn("ft", at("2024-01-09 00:00:00")).withColumn("x", F.lit(2))
    future = old.withColumn("ft", at("2024-01-09 00:00:01")).withColumn("x", F.lit(3))
    week = 7 * 86_400
    assert asof_join(spine, old, "e", "t", "ft", ["x"], week).first()["x"] is None
    assert asof_join(spine, old.unionByName(same_time).unionByName(future), "e", "t", "ft", ["x"], week).first()["x"] == 2
    assert latest_features(old.unionByName(future), "e", "ft").first()["x"] == 3


def test_top_per_group_limits_before_the_shuffle(spark, events):
    plan = R.top_per_group(events, ["user_id"], [F.col("event_ts")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_lookup_spreads_rows_without_a_key(spark):
    from tidewater.operators.joins import lookup

    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("k"))
    dim = spark.createDataFrame([(0, "zero"), (3, "three"), (None, "never")], "k long, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(facts, dim.withColumnRenamed("k", "dk"), "k", "dk", "id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_spread" in plan.split("SortMergeJoin")[1].split("\n")[0]
        same(out, facts.join(dim, "k", "left").select("id", "k", "name"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_percentile_with_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))
    values = sorted(r["x"] for r in df.collect())
    for p in (0.0, 0.2, 0.5, 0.99, 1.0):
        at = (len(values) - 1) * p
        low = int(at)
        exact = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)
        assert R.exact_percentile(df, "x", p).first()["cut"] == pytest.approx(exact)
    assert R.exact_percentile(df.where("x < 0"), "x", 0.5).first()["cut"] is None
