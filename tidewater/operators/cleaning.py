"""Cleaning projections and staging views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.latest import latest_per_key


def clean_strings(
    df: DataFrame,
    trim: Sequence[str] = (),
    lower: Sequence[str] = (),
    defaults: Mapping[str, str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Trim, lower-and-trim and fill text columns; drop rows without a key."""
    changes = {c: F.trim(c) for c in trim}
    changes.update({c: F.lower(F.trim(c)) for c in lower})
    changes.update({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})
    out = df.withColumns(changes) if changes else df
    return out.where(F.col(key).isNotNull()) if key else out


def clean_users(df: DataFrame) -> DataFrame:
    return clean_strings(df, trim=("name", "phone"), lower=("email",), defaults={"status": "unknown"}, key="user_id")


def clean_products(df: DataFrame) -> DataFrame:
    return clean_strings(df, trim=("title", "brand"), key="product_id")


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, with typed nulls for the absent ones."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


# Columns of the cleaned behaviour events.
SILVER_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)


def union_events(branches: Mapping[str, DataFrame], schema: T.StructType = SILVER_EVENT) -> DataFrame:
    """One table from event branches by column name, one row per event id (the latest)."""
    frames = []
    for name, df in branches.items():
        tagged = df.withColumn("event_type", F.lit(name)).withColumn("event_date", F.to_date("ts"))
        frames.append(ensure_columns(tagged, schema).where(F.col("event_id").isNotNull()))
    return latest_per_key(reduce(DataFrame.unionByName, frames), ["event_id"], ["ts"])


def stage_current(dim: DataFrame, key: str) -> DataFrame:
    """Current versions with a key."""
    return dim.where(F.col("is_current") & F.col(key).isNotNull())


def stage_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_id").isNotNull()).withColumn("total_amount", F.col("total_amount").cast("double"))


def stage_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_id").isNotNull() & F.col("ts").isNotNull()).withColumnRenamed("ts", "event_ts")
