"""Feature views over the ends of long plans."""

from pyspark.sql import functions as F

from tidewater.plans.features import FeatureView, historical_features


def test_features_of_long_plans_are_computed_once_and_joined_in_one_order(spark):
    raw = spark.createDataFrame([("a", 10, 1), ("a", 10, 2), ("b", 5, 7)], "u string, t long, x long")
    summed = raw.groupBy("u", "t").agg(F.sum("x").alias("x")).select("u", F.timestamp_seconds("t").alias("t"), "x")
    spine = spark.createDataFrame([(1, "a", 10), (2, "a", 9), (3, "b", 6), (4, "b", 90), (5, None, 6)], "id long, u string, at long")
    out = historical_features(spine.withColumn("at", F.timestamp_seconds("at")), "at", [(FeatureView("sums", "u", "t", 60, ("x",)), summed)])
    assert {(r["id"], r["sums__x"]) for r in out.collect()} == {(1, 3), (2, None), (3, 7), (4, None), (5, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
