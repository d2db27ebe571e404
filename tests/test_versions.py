"""Replacement that survives a crash, and keyed tables built on it."""

import random

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewater.operators import keyed as K
from tidewater.operators import versions as V
from tidewater.operators.merge import merge_partitions, merge_scd2
from tidewater.session import work_dir


class Crash(Exception):
    pass


def crash(*_):
    raise Crash


def days(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, d string").withColumn("d", F.to_date("d"))


def rows(spark, path):
    return sorted((r["id"], r["v"], str(r["d"])) for r in V.read_table(spark, path).collect())


def test_a_crash_before_the_switch_leaves_the_old_rows(spark, monkeypatch):
    path = work_dir(spark, "crash")
    V.replace_partitions(days(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]), path, ["d"])
    before = rows(spark, path)
    again = days(spark, [(1, "A", "2024-01-01")])
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", crash)
        for write in (lambda: V.replace_partitions(again, path, ["d"]), lambda: V.replace_table(again, path), lambda: merge_partitions(spark, path, again, "id", "v", "d")):
            with pytest.raises(Crash):
                write()
            assert rows(spark, path) == before
    V.replace_partitions(again, path, ["d"])
    assert rows(spark, path) == [(1, "A", "2024-01-01"), (2, "b", "2024-01-02")]
    assert V.vacuum(spark, path, older_than_seconds=-60) == 3  # what the three crashes left
    assert rows(spark, path) == [(1, "A", "2024-01-01"), (2, "b", "2024-01-02")]


def test_a_failing_job_leaves_the_old_rows(spark):
    path = work_dir(spark, "failing")
    V.replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        V.replace_table(spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id")), path)
    assert V.read_table(spark, path).count() == 3


def test_marks_recognise_a_repeated_write(spark):
    path = work_dir(spark, "marks")
    assert V.replace_table(spark.range(3), path, mark=("daily", 1))
    assert not V.replace_table(spark.range(9), path, mark=("daily", 1))
    assert V.replace_table(spark.range(4), path, mark=("other", 1)) and V.replace_table(spark.range(5), path, mark=("daily", 2))
    assert not V.replace_table(spark.range(9), path, mark=("other", 1))
    assert V.read_table(spark, path).count() == 5


def test_of_two_writers_one_is_refused(spark):
    path = work_dir(spark, "race")
    V.replace_table(spark.range(3), path)
    base = V.current(spark, path)
    V.write_version(spark.range(4), path, keeps_others=False, base=base)
    with pytest.raises(V.ConcurrentWrite):
        V.write_version(spark.range(5), path, keeps_others=False, base=base)
    assert V.read_table(spark, path).count() == 4
    assert V.read_table(spark, path, base).count() == 3  # a reader that has resolved its state keeps it


def test_partitions_nulls_new_columns_and_empty_writes(spark):
    path = work_dir(spark, "odd")
    V.replace_partitions(days(spark, [(1, "a", "2024-01-01"), (2, "b", None)]), path, ["d"])
    V.replace_partitions(days(spark, []), path, ["d"])
    assert rows(spark, path) == [(1, "a", "2024-01-01"), (2, "b", "None")]
    V.replace_partitions(days(spark, [(3, "c", None)]).withColumn("w", F.lit(7)), path, ["d"])
    assert sorted((r["id"], r["w"]) for r in V.read_table(spark, path).collect()) == [(1, None), (3, 7)]
    with pytest.raises(ValueError, match="partitioned"):
        V.replace_partitions(days(spark, [(3, "c", None)]), path, ["v"])
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, path + "-absent")


def test_merge_partitions_keeps_rows_of_a_null_day(spark):
    path = work_dir(spark, "null-day")
    merge_partitions(spark, path, days(spark, [(1, "a", None), (2, "b", None), (3, "c", "2024-01-01")]), "id", "v", "d", mark=("s", 0))
    batch = days(spark, [(1, "z", None)])
    assert merge_partitions(spark, path, batch, "id", "v", "d", mark=("s", 1)) and not merge_partitions(spark, path, batch, "id", "v", "d", mark=("s", 1))
    assert rows(spark, path) == [(1, "z", "None"), (2, "b", "None"), (3, "c", "2024-01-01")]


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, t long").select("k", "v", F.timestamp_seconds("t").alias("at"))


def spans(df):
    picked = df.select("k", "v", F.unix_timestamp("valid_from").alias("a"), F.unix_timestamp("valid_to").alias("b"), "is_current")
    return sorted(map(tuple, picked.collect()), key=repr)


def brute(spark, rows):
    """Versions of all changes at once; of those at one instant the greatest hash counts."""
    hashes = {r.v: r.h for r in spark.createDataFrame([(v,) for v in {r[1] for r in rows}], "v string").select("v", K.row_hash("v").alias("h")).collect()}
    out = []
    for key in {r[0] for r in rows if r[0] is not None}:
        at = {}
        for k, v, t in rows:
            if k == key and t is not None and (t not in at or hashes[v] > hashes[at[t]]):
                at[t] = v
        line = []
        for t in sorted(at):
            if not line or line[-1][0] != at[t]:
                line.append((at[t], t))
        for i, (v, t) in enumerate(line):
            end = line[i + 1][1] if i + 1 < len(line) else None
            out.append((key, v, t, end, end is None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, cuts", [(1, 1), (2, 4)])
def test_history_is_the_same_for_any_cut_and_order(spark, seed, cuts):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}", rng.choice("ABC"), rng.randrange(900)) for _ in range(250)]
    rows += [(None, "A", 5), ("k1", "B", None), rows[0], rows[1]]
    rng.shuffle(rows)
    path = work_dir(spark, "history")
    for i in range(cuts):
        part = changes(spark, rows[i::cuts])
        assert K.apply_changes(spark, path, part, "k", ["v"], "at", buckets=4, cell_seconds=60, mark=("test", i))
        assert not K.apply_changes(spark, path, part, "k", ["v"], "at", buckets=4, cell_seconds=60, mark=("test", i))
    assert spans(K.read_history(spark, path)) == brute(spark, rows)
    K.apply_changes(spark, path, changes(spark, rows[:40]), "k", ["v"], "at", cell_seconds=60)  # without a mark: nothing new in it
    assert spans(K.read_history(spark, path)) == brute(spark, rows)
    assert K.read_current(spark, path).count() == len({r[0] for r in rows if r[0] and r[2] is not None})


def test_a_late_change_splits_a_closed_version(spark):
    path = work_dir(spark, "late")
    for batch in ([("a", "A", 10), ("a", "A", 50), ("a", "B", 90)], [("a", "B", 30)], [("a", "C", 5)], [("b", "X", 1)]):
        K.apply_changes(spark, path, changes(spark, batch), "k", ["v"], "at", buckets=2)
    a = [s for s in spans(K.read_history(spark, path)) if s[0] == "a"]
    assert [(v, x, y) for _, v, x, y, _ in sorted(a, key=lambda s: s[2])] == [("C", 5, 10), ("A", 10, 30), ("B", 30, 50), ("A", 50, 90), ("B", 90, None)]


def test_a_crash_in_a_merge_leaves_the_history(spark, monkeypatch):
    path = work_dir(spark, "history-crash")
    K.apply_changes(spark, path, changes(spark, [("a", "A", 10), ("b", "A", 10)]), "k", ["v"], "at", buckets=2)
    before = spans(K.read_history(spark, path))
    late = changes(spark, [("a", "B", 5), ("b", "B", 20)])
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", crash)
        with pytest.raises(Crash):
            K.apply_changes(spark, path, late, "k", ["v"], "at", mark=("s", 1))
    assert spans(K.read_history(spark, path)) == before
    assert K.apply_changes(spark, path, late, "k", ["v"], "at", mark=("s", 1))
    assert len(spans(K.read_history(spark, path))) == 4


def opened(spark, path, since):
    """Units that the writes after ``since`` have replaced or added to."""
    now = V.current(spark, path)
    return {u for u, w in now.units.items() if since.units.get(u) != w}


def test_merges_touch_the_buckets_of_their_keys_only(spark):
    path = work_dir(spark, "buckets")
    first = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit("A").alias("v"), F.timestamp_seconds(F.lit(10)).alias("at"))
    K.apply_changes(spark, path, first, "k", ["v"], "at", buckets=16)
    base = V.current(spark, path)
    K.apply_changes(spark, path, changes(spark, [("7", "B", 20)]), "k", ["v"], "at")
    bucket = spark.range(1).select(K.bucket_of(F.lit("7"), 16)).first()[0]
    assert opened(spark, path, base) == {f"_side=open/_bucket={bucket}", f"_side=closed/_bucket={bucket}"}
    base = V.current(spark, path)
    K.apply_changes(spark, path, changes(spark, [("7", "C", 30)]), "k", ["v"], "at")
    closed = V.current(spark, path).units[f"_side=closed/_bucket={bucket}"]
    assert closed[0] == base.units[f"_side=closed/_bucket={bucket}"][0] and len(closed) == 2  # older closed rows lie where they were
    plain = work_dir(spark, "keyed")
    K.upsert_table(spark, plain, first, "k", "at", buckets=16)
    base = V.current(spark, plain)
    K.upsert_table(spark, plain, changes(spark, [("7", "B", 20), ("7", "old", 1), (None, "x", 1)]), "k", "at")
    assert opened(spark, plain, base) == {f"_bucket={bucket}"}
    assert {tuple(r) for r in K.read_keyed(spark, plain).where("k in ('7', '8')").select("k", "v").collect()} == {("7", "B"), ("8", "A")}
    assert K.read_keyed(spark, plain).count() == 400


def test_closed_versions_are_in_no_exchange_of_a_merge(spark):
    target = merge_scd2(None, changes(spark, [("a", "A", 10), ("a", "B", 20), ("b", "A", 10)]), "k", ["v"], "at")
    path = work_dir(spark, "closed")
    target.write.parquet(path)
    out = merge_scd2(spark.read.parquet(path), changes(spark, [("a", "C", 30)]), "k", ["v"], "at")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("not is_current").count() == 2
    first = next(part for part in plan.split("\n") if "Filter" in part)
    assert "is_current" in first and "Union" in plan.split("\n")[0]


@pytest.mark.parametrize("batch", [1, 2])
def test_empty_batches(spark, batch):
    path = work_dir(spark, "empty")
    none = changes(spark, [])
    if batch == 2:
        K.apply_changes(spark, path, changes(spark, [("a", "A", 10)]), "k", ["v"], "at")
    K.apply_changes(spark, path, none, "k", ["v"], "at")
    assert K.read_history(spark, path).count() == batch - 1
    keyed = work_dir(spark, "empty-keyed")
    K.upsert_table(spark, keyed, none, "k", "at")
    K.upsert_table(spark, keyed, none, "k", "at")
    assert K.read_keyed(spark, keyed).count() == 0 and ts("2024-01-01")
