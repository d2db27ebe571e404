"""Change-data-capture envelopes: decode, parse, reduce to current state.

The functions take static and streaming frames alike, except ``current_state``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import parse_ts
from tidewater.operators.latest import latest_per_key

# The public change envelope. Row images stay JSON text until a table needs them.
ENVELOPE = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
LIVE_OPS = ("c", "u", "r")
CORRUPT = "_corrupt"


def parse_envelope(raw: DataFrame) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, partition, offset, timestamp) to bronze CDC rows."""
    text = F.col("value").cast("string")
    return raw.select(
        F.col("key").cast("string").alias("record_key"),
        text.alias("raw_json"),
        F.from_json(text, ENVELOPE).alias("e"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ).select(
        "record_key",
        "raw_json",
        F.col("e.op").alias("cdc_op"),
        F.col("e.ts_ms").alias("cdc_ts_ms"),
        F.col("e.after").alias("payload_after"),
        F.col("e.before").alias("payload_before"),
        "kafka_timestamp",
        "kafka_partition",
        "kafka_offset",
        F.col("kafka_timestamp").alias("event_ts"),
        F.to_date("kafka_timestamp").alias("event_date"),
        F.current_timestamp().alias("ingested_at"),
    )


def is_readable(bronze_json: Column, schema: T.StructType) -> Column:
    """True where text is JSON of the given types; false for null, malformed or mistyped text."""
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(bronze_json, checked, {"columnNameOfCorruptRecord": CORRUPT})
    return bronze_json.isNotNull() & parsed[CORRUPT].isNull()


def keep_ops(bronze: DataFrame, ops: tuple[str, ...] = LIVE_OPS) -> DataFrame:
    return bronze.where(F.col("cdc_op").isin(*ops))


def _as_text(schema: T.StructType) -> T.StructType:
    """Read every field as text, so that a quoted number is not lost."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def typed(payload: str, schema: T.StructType) -> list[Column]:
    """Fields of a text-parsed payload cast to the schema; unreadable values become null."""
    out = []
    for field in schema.fields:
        source = F.col(f"{payload}.{field.name}")
        if isinstance(field.dataType, T.TimestampType):
            value = parse_ts(source)
        elif isinstance(field.dataType, T.StringType):
            value = source
        else:
            value = source.try_cast(field.dataType)
        out.append(value.alias(field.name))
    return out


def parse_payload(bronze: DataFrame, schema: T.StructType, json_col: str = "payload_after", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload columns typed by an explicit schema, plus the kept bronze columns.

    Bronze columns that collide with a payload column take the payload's place
    only if they are not kept.
    """
    parsed = bronze.withColumn("_p", F.from_json(json_col, _as_text(schema)))
    return parsed.select(*typed("_p", schema), *keep)


def current_state(bronze: DataFrame, key: str, schema: T.StructType, deletes: str = "ignore") -> DataFrame:
    """Latest image per key by numeric change time, then kafka position.

    ``deletes="ignore"`` drops delete rows before ranking, so the last image of
    a deleted key stays. ``"apply"`` ranks deletes too, keyed by their before
    image, and drops keys whose last change is a delete.

    Only the key is read from every image. The raw image of the latest change is
    what an aggregate keeps and shuffles, and only survivors are parsed in full.
    """
    if deletes not in ("ignore", "apply"):
        raise ValueError("deletes must be 'ignore' or 'apply'")
    order = ("_ts", "kafka_partition", "kafka_offset")
    rows = bronze.withColumn("_ts", F.col("cdc_ts_ms").try_cast("bigint"))
    if deletes == "ignore":
        rows = rows.where(F.col("cdc_op") != "d")
        image = F.col("payload_after")
    else:
        image = F.when(F.col("cdc_op") == "d", F.col("payload_before")).otherwise(F.col("payload_after"))
    key_only = T.StructType([schema[key]])
    rows = rows.select(image.alias("_image"), "cdc_op", *order)
    keyed = rows.withColumn("_k", F.from_json("_image", _as_text(key_only))).select(*typed("_k", key_only), "_image", "cdc_op", *order)
    last = latest_per_key(keyed, [key], order, drop_null_key=True)
    if deletes == "apply":
        last = last.where(F.col("cdc_op") != "d")
    return parse_payload(last, schema, "_image")


def profile(bronze: DataFrame) -> DataFrame:
    """Rows, unreadable envelopes and change-time range per operation."""
    ts = F.col("cdc_ts_ms").try_cast("bigint")
    return bronze.groupBy(F.coalesce("cdc_op", F.lit("unreadable")).alias("cdc_op")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("payload_after").alias("with_after"),
        F.count("payload_before").alias("with_before"),
        F.min(ts).alias("first_ts_ms"),
        F.max(ts).alias("last_ts_ms"),
    )
