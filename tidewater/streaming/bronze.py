"""Streams from topics into date-partitioned bronze tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.cdc import CORRUPT, parse_envelope
from tidewater.plans.schemas import EVENT_SCHEMAS
from tidewater.sources.bronze import DOMAIN_TOPICS, cdc_topic

Reader = Callable[[str], DataFrame]

CDC_TRIGGER_SECONDS = 30
EVENT_TRIGGER_SECONDS = 15


def parse_event(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed event fields, kafka position and event date."""
    parsed = raw.select(
        F.from_json(F.col("value").cast("string"), schema).alias("event"),
        F.col("timestamp").cast("timestamp").alias("kafka_ts"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )
    return parsed.select("event.*", "kafka_ts", "kafka_partition", "kafka_offset").withColumn("event_date", F.to_date("ts"))


def mandatory(schema: T.StructType) -> Column:
    """True where every field the schema declares not null is present (JSON parsing does not enforce it)."""
    ok = F.lit(True)
    for field in schema.fields:
        if not field.nullable:
            ok = ok & F.col(field.name).isNotNull()
    return ok


def parse_raw_event(raw: DataFrame, name: str) -> DataFrame:
    """A domain event with its payload kept as text."""
    return raw.select(
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("payload_json"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("topic").alias("kafka_topic"),
        F.lit(name).alias("event_name"),
        F.col("timestamp").cast("timestamp").alias("event_ts"),
        F.to_date("timestamp").alias("event_date"),
    )


def write_bronze_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = None,
    partition_by: tuple[str, ...] = ("event_date",),
) -> StreamingQuery:
    """Append to a partitioned Parquet table; without a trigger interval, read what is there and stop."""
    writer = (
        df.writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if trigger_seconds is None else {"processingTime": f"{trigger_seconds} seconds"}
    return writer.trigger(**trigger).start()


def stream_cdc_table(
    read: Reader, table: str, bronze: str, checkpoints: str, trigger_seconds: int | None = CDC_TRIGGER_SECONDS, prefix: str = "cdc"
) -> StreamingQuery:
    """One captured table into ``bronze/cdc/<table>``; an unknown table raises ValueError."""
    raw = read(cdc_topic(table, prefix))
    return write_bronze_stream(parse_envelope(raw), f"{bronze}/cdc/{table}", f"{checkpoints}/cdc/{table}", trigger_seconds)


def stream_typed_topics(
    read: Reader,
    bronze: str,
    checkpoints: str,
    schemas: Mapping[str, T.StructType] = EVENT_SCHEMAS,
    trigger_seconds: int | None = CDC_TRIGGER_SECONDS,
) -> list[StreamingQuery]:
    """One independent stream per topic of the schema registry."""
    out = []
    for topic, schema in schemas.items():
        name = topic.split(".")[-1]
        parsed = parse_event(read(topic), schema)
        out.append(write_bronze_stream(parsed, f"{bronze}/events/{name}", f"{checkpoints}/events/{name}", trigger_seconds))
    return out


def stream_domain_events(
    read: Reader,
    bronze: str,
    checkpoints: str,
    topics: Mapping[str, str] = DOMAIN_TOPICS,
    trigger_seconds: int | None = EVENT_TRIGGER_SECONDS,
) -> list[StreamingQuery]:
    out = []
    for name, topic in topics.items():
        parsed = parse_raw_event(read(topic), name)
        out.append(write_bronze_stream(parsed, f"{bronze}/events/{name}", f"{checkpoints}/events/{name}", trigger_seconds))
    return out


def await_all(spark: SparkSession, streams: list[StreamingQuery]) -> None:
    """Wait until every stream has ended; the first failure stops the rest and is raised."""
    while any(q.isActive for q in streams):
        try:
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        except Exception:
            for q in streams:
                q.stop()
            raise
    for q in streams:
        if q.exception() is not None:
            raise q.exception()


GOOD, DEAD = "good", "dead_letter"


def route_events(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed events with ``route``: unreadable, mistyped or incomplete messages go to the dead letters.

    Written with ``partition_by=("route", "event_date")`` this is one pass into
    two directories, exactly once, with the message text kept on both.
    """
    text = F.col("value").cast("string")
    checked = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(CORRUPT, T.StringType())])
    parsed = raw.select(
        text.alias("message"),
        F.from_json(text, checked, {"columnNameOfCorruptRecord": CORRUPT}).alias("event"),
        F.col("timestamp").cast("timestamp").alias("kafka_ts"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ).select("message", "event.*", "kafka_ts", "kafka_partition", "kafka_offset")
    ok = F.col("message").isNotNull() & F.col(CORRUPT).isNull() & mandatory(schema)
    return parsed.withColumns(
        {"route": F.when(ok, GOOD).otherwise(DEAD), "event_date": F.to_date("kafka_ts")}
    ).drop(CORRUPT)
