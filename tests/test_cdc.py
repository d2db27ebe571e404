import json

import pytest
from conftest import ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import parse_ts
from tidewater.operators import cdc
from tidewater.sources.bronze import cdc_topic
from tidewater.streaming.bronze import parse_raw_event

IMAGE = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def bronze(spark, changes):
    """changes: (op, ts_ms, before, after) with images as dicts or text."""
    rows = []
    for i, (op, at, before, after) in enumerate(changes):
        text = lambda x: x if x is None or isinstance(x, str) else json.dumps(x)
        rows.append((f"k{i}", op, at, text(after), text(before), 0, i))
    return spark.createDataFrame(
        rows, "record_key string, cdc_op string, cdc_ts_ms string, payload_after string, payload_before string, kafka_partition int, kafka_offset long"
    )


def state(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_change_time_is_a_number(spark):
    df = bronze(spark, [("u", "1000", None, {"id": 1, "v": "late"}), ("c", "999", None, {"id": 1, "v": "early"})])
    assert state(cdc.current_state(df, "id", IMAGE)) == {1: "late"}


def test_deletes_ignored_or_applied(spark):
    changes = [("c", "1", None, {"id": 1, "v": "a"}), ("u", "2", {"id": 1, "v": "a"}, {"id": 1, "v": "b"}), ("d", "3", {"id": 1, "v": "b"}, None)]
    df = bronze(spark, changes)
    assert state(cdc.current_state(df, "id", IMAGE)) == {1: "b"}
    assert state(cdc.current_state(df, "id", IMAGE, deletes="apply")) == {}
    with pytest.raises(ValueError):
        cdc.current_state(df, "id", IMAGE, deletes="maybe")


def test_quoted_and_malformed_ids(spark):
    df = bronze(spark, [("c", "1", None, '{"id":"7","v":"x"}'), ("c", "2", None, "{bad")])
    assert state(cdc.current_state(df, "id", IMAGE)) == {7: "x"}
    flags = df.select(cdc.is_readable(F.col("payload_after"), IMAGE).alias("ok")).collect()
    assert [r["ok"] for r in flags] == [False, False]  # a quoted id is not of the declared type
    typed = spark.createDataFrame([('{"id":7,"v":"x"}',), ('{"id":"x"}',), (None,)], "j string")
    assert [r["ok"] for r in typed.select(cdc.is_readable(F.col("j"), IMAGE).alias("ok")).collect()] == [True, False, False]


def test_equal_change_times_fall_back_to_the_offset(spark):
    df = bronze(spark, [("c", "5", None, {"id": 1, "v": "first"}), ("u", "5", None, {"id": 1, "v": "second"})])
    assert state(cdc.current_state(df, "id", IMAGE)) == {1: "second"}


def test_mixed_timestamps(spark):
    texts = ["2024-01-01T10:00:00Z", "1704103200000", "1704103200000000", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_ts("t").cast("timestamp_ntz").alias("at")).collect()
    assert [r["at"] for r in rows] == [ts("2024-01-01 10:00:00")] * 3 + [None, None]


def test_envelope_and_raw_event(spark):
    body = json.dumps({"op": "u", "ts_ms": "17", "before": None, "after": {"id": 1}, "source": {"db": "x"}})
    raw = spark.createDataFrame(
        [(b"1", body.encode(), "t", 2, 9, ts("2024-05-06 07:08:09"))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    row = cdc.parse_envelope(raw).first()
    assert (row["record_key"], row["cdc_op"], row["cdc_ts_ms"], row["payload_after"]) == ("1", "u", "17", '{"id":1}')
    assert row["payload_before"] is None and str(row["event_date"]) == "2024-05-06"
    assert row["ingested_at"] is not None and not isinstance(row["ingested_at"], str)
    event = parse_raw_event(raw, "stock_alert").first()
    assert (event["event_name"], event["kafka_topic"], event["kafka_offset"]) == ("stock_alert", "t", 9)


def test_unknown_table():
    with pytest.raises(ValueError):
        cdc_topic("invalid_table")
