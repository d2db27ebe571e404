"""Operators that select, combine or carry instead of collecting: split, many-view join, sequences, settled streams."""

import random
from collections import Counter, defaultdict

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewater.operators import quality as Q
from tidewater.operators.asof import Source, asof_join_many
from tidewater.operators.sessions import last_items
from tidewater.plans import models as ML
from tidewater.streaming import stateful as ST


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 1.0])
def test_every_class_gives_its_share(spark, share):
    rows = [(i, "rare" if i % 197 == 0 else "odd" if i % 50 == 1 else None if i % 61 == 2 else "common") for i in range(787)]
    got = ML.stratified_split(spark.createDataFrame(rows, "k long, c string"), "k", "c", share).select("k", "c", "is_test", ML.split_hash(F.col("k")).alias("h")).collect()
    sizes = Counter(c for _, c in rows)
    assert sizes["rare"] == 4 and len(got) == 787
    tested = Counter(r.c for r in got if r.is_test)
    assert all(tested[c] == int(n * share + 0.5) for c, n in sizes.items())
    for c in sizes:
        inside, outside = [r.h for r in got if r.c == c and r.is_test], [r.h for r in got if r.c == c and not r.is_test]
        assert not inside or not outside or max(inside) < min(outside)


def test_rows_of_one_key_stay_together(spark):
    rows = spark.createDataFrame([(i % 40, 1) for i in range(400)], "k long, c int")
    marked = ML.stratified_split(rows, "k", "c", 0.3)
    assert marked.groupBy("k").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count() == 0
    assert marked.where("is_test").count() == 120
    assert ML.stratified_split(rows.limit(0), "k", "c", 0.3).count() == 0


def test_many_views_equal_brute_force(spark):
    rng = random.Random(5)
    user = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"u{rng.randrange(5)}"
    spine = [(i, user(), rng.randrange(4000)) for i in range(150)]
    views = {"a": [(user(), rng.randrange(4000), rng.randrange(90)) for _ in range(80)], "b": [(user(), rng.randrange(4000), rng.randrange(90)) for _ in range(9)], "c": []}
    ttl = {"a": 300, "b": None, "c": 10}
    at = lambda df: df.withColumn("t", F.timestamp_seconds("t"))
    sources = [Source(n, at(spark.createDataFrame(r, "u string, t long, x long")), "t", ("x",), ttl[n]) for n, r in views.items()]
    got = asof_join_many(at(spark.createDataFrame(spine, "id long, u string, t long")), sources, "u", "t", cell_seconds=60).collect()
    want = {}
    for i, u, t in spine:
        line = []
        for n, rows in views.items():
            hits = [(s, x) for v, s, x in rows if v == u and u is not None and s <= t]
            best = max(hits, default=None)
            line.append(best[1] if best and (ttl[n] is None or best[0] >= t - ttl[n]) else None)
        want[i] = line
    assert {r["id"]: [r["a__x"], r["b__x"], r["c__x"]] for r in got} == want


def test_the_spine_is_moved_once(spark):
    spine = spark.range(100).select(F.col("id").alias("marker"), (F.col("id") % 7).alias("u"), F.timestamp_seconds("id").alias("t"))
    view = spark.range(50).select((F.col("id") % 7).alias("u"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("x"))
    out = asof_join_many(spine, [Source(n, view, "t", ("x",), None) for n in "abc"], "u", "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [part for part in plan.split("Exchange")[1:] if "marker" in part.split("Exchange")[0]]
    assert plan.count("Window") >= 2 and len(moved) == 1


def test_last_items_of_every_session(spark):
    rng = random.Random(7)
    rows, at = [], 0
    for i in range(400):
        at += rng.choice([1, 30, 4000])
        rows.append((i, "hot" if rng.random() < 0.5 else f"u{rng.randrange(4)}", at, rng.choice([None, *range(9)])))
    events = spark.createDataFrame(rows, "event_id long, user_id string, s long, product_id long").withColumn("event_ts", F.timestamp_seconds("s"))
    sessions, last = defaultdict(list), {}
    for i, u, s, p in rows:
        number, before = last.get(u, (0, None))
        number += before is None or (s - before) // 60 > 30
        last[u] = (number, s)
        if p is not None:
            sessions[u, number].append(p)
    want = sorted((u, items[-5:]) for (u, _), items in sessions.items() if len(items) >= 2)
    got = sorted((r["user_id"], list(r["items"])) for r in last_items(events, 30, 5, 2).collect())
    assert got == want
    plan = last_items(events, 30, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # at most 5 rows per session leave a task
    with pytest.raises(ValueError, match="min_length"):
        last_items(events, 30, 5, 6)


def test_a_suite_reads_its_rows_once(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "b", -1.0), (2, None, None), (None, "b", 5.0)], "k long, v string, x double")
    rules = (Q.unique("k"), Q.unique("v", where="x > 0"), Q.unique("v"), Q.not_null("v"), Q.between("x", low=0), Q.row_count(low=1), Q.exists("nope"))
    out = Q.run_suite(rows, rules)
    got = [(r.rule, r.failing, r.total, r.passed) for r in out.collect()]
    assert got == [("unique(k)", 2, 4, False), ("unique(v)", 0, 2, True), ("unique(v)", 2, 4, False), ("not_null(v)", 1, 4, False), ("between(x)", 1, 4, False), ("row_count", 0, 4, True), ("exists(nope)", 1, 4, False)]
    assert out._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    empty = Q.run_suite(rows.limit(0), rules).collect()
    assert [(r.failing, r.total) for r in empty] == [(0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (1, 0), (1, 0)]


def stamped(spark, rows):
    return spark.createDataFrame([(u, ts(f"2024-01-01 {t}")) for u, t in rows], "user_id string, ts timestamp")


def test_open_and_late_minutes_are_settled(spark):
    written = stamped(spark, [("a", "10:00:05"), ("a", "10:00:50"), ("b", "10:00:59"), ("a", "10:01:00"), ("a", "11:30:00"), (None, "11:30:00")])
    emitted = spark.createDataFrame([(ts("2024-01-01 10:00:00"), "a", 1), (ts("2024-01-01 10:00:00"), "b", 1)], "minute timestamp, user_id string, events long")
    got = {(str(r.minute)[11:16], r.user_id): (r.events, r.state) for r in ST.settle_rates(emitted, written, by=("user_id",)).collect()}
    assert got == {("10:00", "a"): (2, "late"), ("10:00", "b"): (1, "emitted"), ("10:01", "a"): (1, "open"), ("11:30", "a"): (1, "open"), ("11:30", None): (1, "open")}


def test_late_rows_join_sessions_that_were_emitted_apart(spark):
    # b is settled as it is; a's late event at 10:25 joins two emitted sessions; c is still open
    written = stamped(spark, [("a", "10:00:00"), ("a", "10:25:00"), ("a", "10:50:00"), ("b", "09:00:00"), ("c", "12:00:00"), ("c", "12:30:00"), ("c", "13:00:01")])
    line = lambda u, a, z, n: (u, ts(f"2024-01-01 {a}"), ts(f"2024-01-01 {z}"), n)
    emitted = spark.createDataFrame([line("a", "10:00:00", "10:30:00", 1), line("a", "10:50:00", "11:20:00", 1), line("b", "09:00:00", "09:30:00", 1)], "user_id string, session_start timestamp, session_end timestamp, event_count long")
    got = sorted((r.user_id, str(r.session_start)[11:], str(r.session_end)[11:], r.event_count, r.state) for r in ST.settle_sessions(emitted, written).collect())
    assert got == [
        ("a", "10:00:00", "11:20:00", 3, "settled"),
        ("b", "09:00:00", "09:30:00", 1, "emitted"),
        ("c", "12:00:00", "13:00:00", 2, "settled"),
        ("c", "13:00:01", "13:30:01", 1, "settled"),
    ]


def test_rows_dropped_as_late_are_found_again(spark):
    written = spark.createDataFrame([("1", 5, "x"), ("2", 9, "late"), ("2", 7, "first"), ("1", 6, "again")], "event_id string, n int, v string")
    emitted = written.where("v = 'x'")
    assert sorted(map(tuple, ST.settle_dedup(emitted, written, "event_id", ["n"]).collect())) == [("1", 5, "x"), ("2", 7, "first")]
