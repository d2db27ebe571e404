import json

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewater.operators.cdc import parse_envelope
from tidewater.operators.keyed import read_history
from tidewater.operators.versions import read_table
from tidewater.plans.schemas import CLICK
from tidewater.session import work_dir
from tidewater.sources.bronze import replay_topic
from tidewater.streaming import bronze as B
from tidewater.streaming import stateful as ST


def recorded(spark, bodies, at="2024-01-01 10:00:00"):
    path = work_dir(spark, "topic")
    rows = [(str(i).encode(), None if b is None else b.encode(), "t", 0, i, ts(at)) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp").write.parquet(path)
    return lambda topic: replay_topic(spark, path), spark.read.parquet(path)


def test_cdc_stream_equals_batch_and_restarts_without_repeats(spark):
    bodies = [json.dumps({"op": "c", "ts_ms": str(i), "after": {"id": i}}) for i in range(20)] + ["{bad"]
    read, batch = recorded(spark, bodies)
    root, marks = work_dir(spark, "bronze"), work_dir(spark, "marks")
    for _ in range(2):
        B.stream_cdc_table(read, "orders", root, marks, trigger_seconds=None).awaitTermination()
    got = spark.read.parquet(f"{root}/cdc/orders").drop("ingested_at")
    want = parse_envelope(batch).drop("ingested_at").select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_dead_letters(spark):
    good = {"event_id": "1", "ts": "2024-01-01T00:00:00Z", "position": 3}
    bodies = [json.dumps(good), "{bad", json.dumps({**good, "position": "x"}), json.dumps({"event_id": "2"}), None]
    read, batch = recorded(spark, bodies)
    routed = B.route_events(batch, CLICK).orderBy("kafka_offset").collect()
    assert [r["route"] for r in routed] == ["good", "dead_letter", "dead_letter", "dead_letter", "dead_letter"]
    assert routed[1]["message"] == "{bad"


def test_domain_and_typed_topics(spark):
    read, _ = recorded(spark, [json.dumps({"event_id": "1", "ts": "2024-01-02T00:00:00Z", "position": 3})])
    root, marks = work_dir(spark, "bronze"), work_dir(spark, "marks")
    streams = B.stream_domain_events(read, root, marks, {"stock_alert": "stock-alert"}, None)
    streams += B.stream_typed_topics(read, root, marks, {"events.clicks": CLICK}, None)
    B.await_all(spark, streams)
    assert spark.read.parquet(f"{root}/events/stock_alert").first()["event_name"] == "stock_alert"
    click = spark.read.parquet(f"{root}/events/clicks").first()
    assert (click["position"], str(click["event_date"])) == (3, "2024-01-02")


def test_failure_of_one_stream_is_raised(spark):
    read, _ = recorded(spark, [json.dumps({"event_id": "1"})])
    bad = read("t").select(F.raise_error(F.lit("boom")).cast("string").alias("x"), F.to_date("timestamp").alias("event_date"))
    stream = B.write_bronze_stream(bad, work_dir(spark, "bad"), work_dir(spark, "marks"))
    with pytest.raises(Exception, match="boom"):
        B.await_all(spark, [stream])


def test_dedup_and_merge(spark):
    path = work_dir(spark, "events")
    rows = [(str(i % 7), ts(f"2024-01-0{1 + i % 2} 00:00:0{i % 10}"), i) for i in range(20)]
    spark.createDataFrame(rows, "event_id string, ts timestamp, n int").write.parquet(path)
    stream = spark.readStream.schema("event_id string, ts timestamp, n int").parquet(path)
    out = work_dir(spark, "deduped")
    once = ST.dedup(stream, delay="10 days").withColumn("event_date", F.to_date("ts"))
    B.write_bronze_stream(once, out, work_dir(spark, "marks")).awaitTermination()
    assert spark.read.parquet(out).count() == 7
    silver = work_dir(spark, "silver")
    fixed = stream.withColumn("event_date", F.lit("2024-01-01").cast("date"))
    for _ in range(2):
        ST.stream_merge(fixed, silver, work_dir(spark, "marks"), "event_id", "ts", "event_date").awaitTermination()
    latest = {}
    for key, at, n in rows:
        latest[key] = max(latest.get(key, (at, n)), (at, n))
    got = {r["event_id"]: r["n"] for r in read_table(spark, silver).collect()}
    assert got.keys() == latest.keys() and all(r[0] == max(a for k, a, _ in rows if k == key) for key, r in latest.items())


def test_scd2_stream_applies_a_batch_once_across_crashes(spark, monkeypatch):
    """The first run ends after a batch was published and before the stream knows; the second starts with that batch again."""
    source, path, marks = work_dir(spark, "changes"), work_dir(spark, "history"), work_dir(spark, "marks")
    rows = [("a", "A", "2024-01-05"), ("a", "B", "2024-01-03"), ("b", "X", "2024-01-01"), ("a", "A", "2024-01-01"), ("b", "Y", "2024-01-02"), ("a", "C", "2024-01-04")]
    changes = spark.createDataFrame([(k, v, ts(t)) for k, v, t in rows], "k string, v string, at timestamp")
    for i in range(3):
        part = spark.createDataFrame([(k, v, ts(t)) for k, v, t in rows[2 * i : 2 * i + 2]], changes.schema)
        part.coalesce(1).write.mode("append").parquet(source)
    original, applied = ST.apply_changes, []

    def crashing(*args, **options):
        applied.append(original(*args, **options))
        if len(applied) == 2:
            raise RuntimeError("crash after the switch")

    monkeypatch.setattr(ST, "apply_changes", crashing)
    for run in range(2):
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = ST.stream_scd2(stream, path, marks, "k", ["v"], "at", buckets=2)
        if run == 0:
            with pytest.raises(Exception, match="crash after the switch"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert applied == [True, True, False, True]
    got = sorted((r.k, str(r.valid_from)[:10], r.v, r.is_current) for r in read_history(spark, path).collect())
    assert got == [
        ("a", "2024-01-01", "A", False),
        ("a", "2024-01-03", "B", False),
        ("a", "2024-01-04", "C", False),
        ("a", "2024-01-05", "A", True),
        ("b", "2024-01-01", "X", False),
        ("b", "2024-01-02", "Y", True),
    ]


def test_monitoring_and_sessions_match_batch_for_closed_windows(spark):
    path = work_dir(spark, "events")
    rows = [("u", ts(f"2024-01-01 0{h}:{m:02d}:00")) for h, m in ((0, 0), (0, 10), (0, 10), (1, 0), (5, 0))]
    spark.createDataFrame(rows, "user_id string, ts timestamp").write.parquet(path)
    stream = spark.readStream.schema("user_id string, ts timestamp").parquet(path)
    rates, sessions = work_dir(spark, "rates"), work_dir(spark, "sessions")
    B.write_bronze_stream(ST.rate_per_minute(stream).withColumn("event_date", F.to_date("minute")), rates, work_dir(spark, "m")).awaitTermination()
    B.write_bronze_stream(ST.session_windows(stream).withColumn("event_date", F.to_date("session_start")), sessions, work_dir(spark, "m")).awaitTermination()
    assert sorted(r["events"] for r in spark.read.parquet(rates).collect()) == [1, 1, 2]
    assert sorted(r["event_count"] for r in spark.read.parquet(sessions).collect()) == [1, 3]


def test_topic_reader_builds_without_the_connector(spark):
    from tidewater.sources.bronze import topic_reader

    assert topic_reader(spark, "cdc.products", "broker:9092", 50_000) is not None
