"""One user with a third of all rows in one hour: results as before, no cell with more than its share."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import micros
from tidewater.operators import timecells as TC
from tidewater.operators.asof import asof_join

HOUR = 3600


@pytest.fixture(scope="module")
def events(spark):
    rng, rows, start = random.Random(9), [], 1_700_000_000_000_000
    for i in range(3000):
        user, at = (None if i % 50 == 0 else f"u{rng.randrange(9)}"), rng.randrange(20 * HOUR * 1_000_000)
        if i % 3 == 0:
            user, at = "hot", 5 * HOUR * 1_000_000 + int(rng.random() ** 3 * HOUR * 1_000_000)  # crowded at the start of the hour
        rows.append((i, user, start + at - at % 1000))
    df = spark.createDataFrame(rows, "id long, u string, at long")
    return df.select("id", "u", F.timestamp_micros("at").alias("ts")).cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def by_user():
    return Window.partitionBy("u").orderBy("ts", "id")


def test_no_cell_holds_more_than_four_times_its_share(events):
    celled = events.withColumn(TC.CELL, TC.cell_of("ts", HOUR))
    before = celled.groupBy("u", TC.CELL).count().agg(F.max("count")).first()[0]
    rows, summary = TC.summarised(celled, "u", micros("ts"), [], cell_rows=40)
    sizes = [r[0] for r in summary.select("_rows").collect()]
    assert before > 900 and sum(sizes) == 3000 and rows.count() == 3000
    assert max(sizes) <= 4 * 40
    # cells keep the order of time
    crossing = rows.withColumn("later", F.lead(TC.CELL).over(by_user())).where(F.col("later") < F.col(TC.CELL))
    assert crossing.count() == 0


@pytest.mark.parametrize("cell_rows", [30, 10**6])
def test_results_are_those_of_plain_windows(events, cell_rows):
    cell = HOUR
    got = TC.with_prior_totals(events, "u", "ts", ["ts", "id"], {"n": F.lit(1), "s": F.col("id")}, cell, cell_rows)
    w = by_user().rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("u").isNotNull()
    want = events.withColumn("n", F.when(known, F.count(F.lit(1)).over(w)).otherwise(0)).withColumn("s", F.when(known, F.coalesce(F.sum("id").over(w), F.lit(0))).otherwise(0))
    same(got.select("id", "n", "s"), want.select("id", "n", "s"))
    for seconds in (600, 4 * HOUR):
        got = TC.with_trailing_count(events, "u", "ts", seconds, "n", cell_rows)
        w = Window.partitionBy("u").orderBy(F.unix_micros("ts")).rangeBetween(-seconds * 1_000_000, 0)
        same(got.select("id", "u", "ts", "n"), events.withColumn("n", F.count(F.lit(1)).over(w)).select("id", "u", "ts", "n"))
    for after, shift in ((False, F.lag), (True, F.lead)):
        got = TC.with_neighbour(events.where(known), "u", "ts", ["ts", "id"], ["id"], "nb", after, cell, cell_rows)
        same(got.select("id", F.col("nb.id").alias("nb")), events.where(known).select("id", shift("id").over(by_user()).alias("nb")))


@pytest.mark.parametrize("cell_rows", [30, 10**6])
def test_point_in_time_values(events, cell_rows):
    spine = events.where("id % 2 = 0")
    features = events.where("id % 2 = 1 and u is not null").select("u", F.col("ts").alias("ft"), F.col("id").alias("v"))
    got = asof_join(spine, features, "u", "ts", "ft", ["v"], 900, HOUR, cell_rows)
    at = F.unix_micros("ts")
    both = spine.select("id", "u", "ts", F.lit(1).alias("side"), F.lit(None).cast("struct<ft: timestamp, v: bigint>").alias("f"))
    both = both.unionByName(features.select(F.lit(None).cast("long").alias("id"), "u", F.col("ft").alias("ts"), F.lit(0).alias("side"), F.struct("ft", "v").alias("f")))
    line = Window.partitionBy("u").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, 0)
    want = both.withColumn("h", F.max("f").over(line)).where("side = 1").withColumn("h", F.when(F.unix_micros("h.ft") >= at - 900_000_000, F.col("h")))
    same(got.select("id", "feature_ts", "v"), want.select("id", "h.ft", "h.v"))


@pytest.mark.parametrize("cell_rows", [30, 10**6])
def test_runs_of_equal_values(events, cell_rows):
    rows = events.where("u is not null").withColumn("v", F.col("id") % 3 == 0)
    got = TC.with_runs(rows, "u", "ts", ["ts", "id"], "v", HOUR, cell_rows)
    marked = rows.withColumn("p", F.lag("v").over(by_user())).withColumn("s", F.col("p").isNull() | (F.col("p") != F.col("v")))
    starts = marked.where("s").withColumn("until", F.lead("ts").over(by_user()))
    want = starts.select("id", "s", "until").unionByName(marked.where("not s").select("id", "s", F.lit(None).cast("timestamp").alias("until")))
    same(got.select("id", "_starts", "_until"), want)
