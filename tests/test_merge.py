import random

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewater.operators import merge as M
from tidewater.operators import versions as V
from tidewater.session import work_dir


def versions(df, key="k"):
    rows = df.orderBy(key, "valid_from").collect()
    return [(r[key], r["v"], r["valid_from"], r["valid_to"], r["is_current"]) for r in rows]


def updates(spark, rows):
    return spark.createDataFrame([(k, v, ts(t)) for k, v, t in rows], "k string, v string, at timestamp")


def test_missing_key_column(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="k"):
        M.merge_scd2(None, df, "k", ["x"], "x")
    with pytest.raises(ValueError, match="k"):
        M.upsert(None, df, "k", "x")


def test_row_hash_adds_one_column_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id int, v string")
    out = M.add_row_hash(df, ["v"])
    assert out.columns == ["id", "v", "row_hash"]
    assert out.select("row_hash").distinct().count() == 2


def test_several_changes_in_one_batch(spark):
    out = versions(M.merge_scd2(None, updates(spark, [("a", "A", "2024-01-01"), ("a", "B", "2024-01-02"), ("a", "B", "2024-01-03"), ("a", "C", "2024-01-04")]), "k", ["v"], "at"))
    assert [(v, f.day, t.day if t else None, c) for _, v, f, t, c in out] == [("A", 1, 2, False), ("B", 2, 4, False), ("C", 4, None, True)]


def test_back_to_an_old_value_and_rerun(spark):
    table = M.merge_scd2(None, updates(spark, [("a", "A", "2024-01-01"), ("b", "X", "2024-01-01")]), "k", ["v"], "at")
    for v, t in (("B", "2024-01-02"), ("A", "2024-01-03")):
        batch = updates(spark, [("a", v, t), ("c", "new", t)])
        table = M.merge_scd2(table, batch, "k", ["v"], "at")
        assert versions(M.merge_scd2(table, batch, "k", ["v"], "at")) == versions(table)
    assert [r[1] for r in versions(table) if r[0] == "a"] == ["A", "B", "A"]
    assert [r[1] for r in versions(table) if r[0] == "b"] == ["X"]
    assert table.where("is_current").groupBy("k").count().where("count > 1").count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_history_equals_brute_force_for_a_hot_key(spark, seed):
    rng = random.Random(seed)
    rows, at = [], 0
    for _ in range(200):
        at += rng.choice([1, 5, 400])
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}"
        rows.append((key, rng.choice("AB"), at))
    df = spark.createDataFrame(rows, "k string, v string, t long").select("k", "v", F.timestamp_seconds("t").alias("at"))
    cut = at // 2
    first = M.merge_scd2(None, df.where(F.unix_timestamp("at") <= cut), "k", ["v"], "at", cell_seconds=60)
    got = M.merge_scd2(first, df.where(F.unix_timestamp("at") > cut), "k", ["v"], "at", cell_seconds=60)
    want = []
    for key in {r[0] for r in rows}:
        line = []
        for _, v, t in sorted(r for r in rows if r[0] == key):
            pass
        for _, v, t in sorted((r for r in rows if r[0] == key), key=lambda r: r[2]):
            if not line or line[-1][0] != v:
                line.append((v, t))
        for i, (v, t) in enumerate(line):
            want.append((key, v, t, line[i + 1][1] if i + 1 < len(line) else None))
    have = [(r["k"], r["v"], int(r["a"]), r["b"]) for r in got.select("k", "v", F.unix_timestamp("valid_from").alias("a"), F.unix_timestamp("valid_to").alias("b")).collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_upsert_keeps_the_newest_and_is_idempotent(spark):
    cols = "k long, v string, at int"
    target = spark.createDataFrame([(1, "old", 5), (2, "keep", 9)], cols)
    batch = spark.createDataFrame([(1, "new", 6), (2, "stale", 8), (3, "add", 1), (3, "add2", 2)], cols)
    once = M.upsert(target, batch, "k", "at")
    assert sorted(map(tuple, once.collect())) == [(1, "new", 6), (2, "keep", 9), (3, "add2", 2)]
    assert sorted(map(tuple, M.upsert(once, batch, "k", "at").collect())) == sorted(map(tuple, once.collect()))


def test_partition_writes(spark):
    path = work_dir(spark, "partitions")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id long, d string").withColumn("d", F.to_date("d"))
    M.overwrite_partitions(df, path, ["d"])
    M.overwrite_partitions(df.where("id = 2").withColumn("id", F.lit(20).cast("long")), path, ["d"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 20]
    batch = spark.createDataFrame([(1, "x", 3, "2024-01-01"), (5, "y", 1, "2024-01-03")], "id long, v string, at int, d string").withColumn("d", F.to_date("d"))
    merged = work_dir(spark, "merged")
    for _ in range(2):
        M.merge_partitions(spark, merged, batch, "id", "at", "d")
    M.merge_partitions(spark, merged, batch.where("id = 1").withColumn("at", F.lit(4)).withColumn("v", F.lit("z")), "id", "at", "d")
    assert sorted((r["id"], r["v"]) for r in V.read_table(spark, merged).collect()) == [(1, "z"), (5, "y")]


def test_overwrite_table_allows_a_new_schema(spark):
    path = work_dir(spark, "table")
    V.replace_table(spark.range(3), path)
    V.replace_table(spark.range(2).withColumn("x", F.lit("a")), path)
    again = V.read_table(spark, path)
    assert again.columns == ["id", "x"] and again.count() == 2


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-31",)], "d string").withColumn("d", F.to_date("d"))
    assert M.retain(df, "d", 30, F.lit("2024-04-01").cast("date")).count() == 1
