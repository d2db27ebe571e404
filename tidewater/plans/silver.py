"""Bronze to silver: parse, clean, merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import parse_ts
from tidewater.operators.cdc import keep_ops, parse_payload
from tidewater.operators.cleaning import clean_products, clean_users, union_events
from tidewater.operators.latest import latest_per_key
from tidewater.operators.merge import merge_scd2, upsert
from tidewater.plans.schemas import PRODUCT_TRACKED, SILVER_ORDER, SILVER_PRODUCT, SILVER_USER, USER_TRACKED


def _parsed(bronze: DataFrame, schema: T.StructType) -> DataFrame:
    """Payload rows whose update time falls back to creation and then to change time."""
    rows = parse_payload(bronze, schema, keep=("cdc_ts_ms",))
    return rows.withColumn("updated_at", F.coalesce("updated_at", "created_at", parse_ts("cdc_ts_ms"))).drop("cdc_ts_ms")


def user_updates(bronze: DataFrame) -> DataFrame:
    return clean_users(_parsed(keep_ops(bronze), SILVER_USER))


def product_updates(bronze: DataFrame) -> DataFrame:
    return clean_products(_parsed(keep_ops(bronze), SILVER_PRODUCT))


def order_updates(bronze: DataFrame) -> DataFrame:
    """One row per order, the newest."""
    rows = _parsed(bronze, SILVER_ORDER).where(F.col("order_id").isNotNull())
    return latest_per_key(rows, ["order_id"], ["updated_at"])


def silver_users(target: DataFrame | None, bronze: DataFrame) -> DataFrame:
    return merge_scd2(target, user_updates(bronze), "user_id", USER_TRACKED, "updated_at")


def silver_products(target: DataFrame | None, bronze: DataFrame) -> DataFrame:
    return merge_scd2(target, product_updates(bronze), "product_id", PRODUCT_TRACKED, "updated_at")


def silver_orders(target: DataFrame | None, bronze: DataFrame) -> DataFrame:
    return upsert(target, order_updates(bronze), "order_id", "updated_at")


def silver_events(target: DataFrame | None, topics: Mapping[str, DataFrame]) -> DataFrame:
    """Events of the available topics merged into the table by event id."""
    return upsert(target, union_events(topics), "event_id", "ts")
