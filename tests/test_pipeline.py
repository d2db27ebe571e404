import json

from pyspark.sql import functions as F

from tidewater.operators import merge as M
from tidewater.plans import operational as OP
from tidewater.plans import silver as SI
from tidewater.session import work_dir


def bronze(spark, images):
    rows = [("c", str(i), json.dumps(image), None, 0, i) for i, image in enumerate(images)]
    return spark.createDataFrame(
        rows, "cdc_op string, cdc_ts_ms string, payload_after string, payload_before string, kafka_partition int, kafka_offset long"
    )


def test_silver_products_history(spark):
    p = {"product_id": "1", "title": " Ring ", "price": 9.5, "stock_quantity": 3, "created_at": "2024-01-01T00:00:00Z"}
    first = SI.silver_products(None, bronze(spark, [p]))
    second = SI.silver_products(first, bronze(spark, [{**p, "price": 8.0, "updated_at": "2024-01-02T00:00:00Z"}]))
    rows = second.orderBy("valid_from").collect()
    assert [(r["title"], float(r["price"]), r["is_current"]) for r in rows] == [("Ring", 9.5, False), ("Ring", 8.0, True)]
    assert rows[0]["valid_to"] == rows[1]["valid_from"]


def test_changed_email_shows_history_and_rerun_adds_nothing(spark):
    u = {"user_id": "1", "email": "A@x.y", "created_at": "1704067200000"}
    changed = bronze(spark, [{**u, "email": "b@x.y", "updated_at": "1704153600000"}])
    table = SI.silver_users(SI.silver_users(None, bronze(spark, [u])), changed)
    again = SI.silver_users(table, changed)
    for df in (table, again):
        rows = df.orderBy("valid_from").collect()
        assert [(r["email"], r["status"], r["is_current"]) for r in rows] == [("a@x.y", "unknown", False), ("b@x.y", "unknown", True)]


def test_operational_gold_isolates_failures(spark):
    sources = {
        "cdc/users": bronze(spark, [{"id": 1, "name": "n", "user_type": "BUYER"}]),
        "cdc/orders": spark.range(1),  # not a CDC table
        "cdc/notifications": bronze(spark, [{"id": 1, "channel": "email", "event_type": "x", "created_at": "2024-01-01"}] * 2),
        "events/stock_alert": spark.createDataFrame([('{"product_id": 5, "stock": 1}',), ('{"stock": 1}',)], "payload_json string")
        .withColumn("event_ts", F.current_timestamp())
        .withColumn("event_date", F.current_date()),
    }
    built = {}
    failures = OP.build_gold(sources.get, lambda name, df: built.__setitem__(name, df.collect()))
    assert set(failures) == {"fact_orders"}
    assert set(built) == {"dim_users", "notifications_daily", "fact_stock_alerts"}
    assert built["notifications_daily"][0]["notifications"] == 1 and len(built["fact_stock_alerts"]) == 1


def test_write_counted(spark):
    path = work_dir(spark, "counted")
    assert M.write_counted(spark.range(7), lambda df: df.write.parquet(path)) == 7


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql("DROP TABLE IF EXISTS b_left")
    spark.sql("DROP TABLE IF EXISTS b_right")
    M.save_bucketed(spark.range(100).withColumnRenamed("id", "k"), "b_left", ["k"], 4)
    M.save_bucketed(spark.range(100).withColumnRenamed("id", "k").withColumn("v", F.lit(1)), "b_right", ["k"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_left").join(spark.table("b_right"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE b_left")
        spark.sql("DROP TABLE b_right")
