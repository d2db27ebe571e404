"""Bronze and gold table scans."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidewater.operators.merge import table_exists

log = logging.getLogger(__name__)

# The captured tables and the topic of each domain event.
CAPTURED = ("products", "payments", "notifications", "users", "orders")

DOMAIN_TOPICS = {
    "order_created": "order-created",
    "payment_confirmed": "payment-confirmed",
    "payment_failed": "payment-failed",
    "product_created": "product-created",
    "stock_updates": "stock-updates",
    "stock_alert": "stock-alert",
}

# Columns of a Kafka read; file replays in tests carry the same ones.
KAFKA_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def cdc_topic(table: str, prefix: str = "cdc") -> str:
    """Topic of a captured table below the connector's prefix."""
    if table not in CAPTURED:
        raise ValueError(f"unknown table '{table}', known: {sorted(CAPTURED)}")
    return f"{prefix}.{table}"


def topic_reader(spark: SparkSession, topic: str, servers: str, max_per_trigger: int = 100_000) -> DataStreamReader:
    """Reader for a topic from its earliest offset, rate limited, tolerant of expired data."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", max_per_trigger)
    )


def read_topic_stream(spark: SparkSession, topic: str, servers: str, max_per_trigger: int = 100_000) -> DataFrame:
    return topic_reader(spark, topic, servers, max_per_trigger).load()


def replay_topic(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The same columns from recorded Parquet files, as a stream."""
    return spark.readStream.schema(KAFKA_ROW).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def read_bronze(spark: SparkSession, path: str, date: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A date-partitioned table, or one day of it by partition pruning."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if date is None else df.where(F.col("event_date") == F.lit(date).cast("date"))


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table, or None with a warning when it is missing or empty."""
    if not table_exists(spark, path):
        log.warning("%s is missing, skipped", path)
        return None
    df = read_bronze(spark, path, schema=schema)
    if df.isEmpty():
        log.warning("%s is empty, skipped", path)
        return None
    return df


def read_table(spark: SparkSession, layer: str, name: str, root: str | None = None) -> DataFrame:
    """A gold or feature table by name: from the catalog, or as Parquet below ``root``."""
    return spark.table(f"{layer}.{name}") if root is None else spark.read.parquet(f"{root}/{layer}/{name}")
