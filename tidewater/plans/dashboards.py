"""Dashboard queries over gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import bucketize, guarded_ratio, last_days
from tidewater.plans.marts import LIVE, sold


def _recent(df: DataFrame, date_col: str, days: int | None, as_of: Column | None) -> DataFrame:
    return df if days is None else df.where(last_days(date_col, days, as_of))


def gmv_by_day(orders: DataFrame, days: int | None = None, as_of: Column | None = None, statuses: Sequence[str] = LIVE) -> DataFrame:
    rows = _recent(sold(orders, statuses).where(F.col("created_at").isNotNull()), "created_at", days, as_of)
    return rows.groupBy(F.to_date("created_at").alias("order_date")).agg(
        F.sum("total_amount").alias("gmv"), F.count(F.lit(1)).alias("orders"), F.avg("total_amount").alias("aov")
    )


def payments_by_day(payments: DataFrame, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    rows = _recent(payments.where(F.col("created_at").isNotNull()), "created_at", days, as_of)
    daily = rows.groupBy(F.to_date("created_at").alias("pay_date")).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == "CONFIRMED").alias("confirmed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )
    return daily.withColumn("confirmed_pct", guarded_ratio("confirmed", "attempts") * 100)


def status_mix(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def gmv_half_over_half(daily: DataFrame) -> DataFrame:
    """Totals of a daily series and the change of its second half over its first.

    The first half is the earlier ``n div 2`` days, at least one. One row per
    day goes in, so the ordered window is bounded by the calendar.
    """
    ranked = daily.withColumns(
        {
            "_pos": F.row_number().over(Window.orderBy("order_date")),
            "_n": F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))),
        }
    )
    first = F.col("_pos") <= F.greatest(F.floor(F.col("_n") / 2), F.lit(1))
    totals = ranked.agg(
        F.sum("gmv").alias("gmv_total"),
        F.sum("orders").alias("orders_total"),
        F.avg("aov").alias("aov_avg"),
        F.coalesce(F.sum(F.when(first, F.col("gmv"))), F.lit(0.0)).alias("prev_gmv"),
        F.coalesce(F.sum(F.when(~first, F.col("gmv"))), F.lit(0.0)).alias("curr_gmv"),
    )
    change = (F.col("curr_gmv") - F.col("prev_gmv")) / F.greatest(F.col("prev_gmv"), F.lit(1.0)) * 100
    return totals.withColumn("delta_pct", change)


def category_sales(daily: DataFrame, products: DataFrame, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    """Sales per category; products without one count as 'unknown'."""
    rows = _recent(daily.where(F.col("order_date").isNotNull()), "order_date", days, as_of)
    per_product = rows.groupBy("product_id").agg(
        F.sum("gmv").alias("gmv"), F.sum("orders").alias("orders"), F.sum("units_sold").alias("units_sold")
    )
    names = products.select("product_id", F.col("category").alias("_category"))
    return (
        per_product.join(names, "product_id", "left")
        .groupBy(F.coalesce("_category", F.lit("unknown")).alias("category"))
        .agg(F.sum("gmv").alias("gmv"), F.sum("orders").alias("orders"), F.sum("units_sold").alias("units_sold"))
    )


def top_products(products: DataFrame, daily: DataFrame, n: int = 25) -> DataFrame:
    """Best sellers with catalogue columns; unsold products take part with zeros."""
    sales = daily.groupBy("product_id").agg(
        F.sum("gmv").alias("gmv"), F.sum("orders").alias("orders"), F.sum("units_sold").alias("units_sold")
    )
    named = products.select(
        "product_id",
        F.coalesce("title", F.col("product_id").cast("string")).alias("product_name"),
        F.coalesce("category", F.lit("unknown")).alias("category"),
        "price",
        "stock",
    )
    filled = named.join(sales, "product_id", "left").fillna({"gmv": 0.0, "orders": 0, "units_sold": 0.0})
    return filled.orderBy(F.round("gmv", 2).desc_nulls_last(), "product_id").limit(n)


def lowest_stock(products: DataFrame, n: int = 15) -> DataFrame:
    return products.select("product_id", "title", "stock").orderBy(F.col("stock").asc_nulls_first(), "product_id").limit(n)


def stock_alerts_by_day(alerts: DataFrame, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    rows = _recent(alerts, "event_date", days, as_of)
    return rows.groupBy(F.col("event_date").alias("alert_date")).agg(F.count(F.lit(1)).alias("alerts"))


def active_buyer_share(users: DataFrame, buyers: DataFrame) -> DataFrame:
    """Registered buyers, buyers seen in ``buyers``, and their share in percent."""
    registered = users.where(F.col("user_type") == "BUYER").agg(F.count(F.lit(1)).alias("registered"))
    active = buyers.agg(F.count(F.lit(1))).scalar()
    return registered.withColumn("active", active).withColumn(
        "active_pct", F.col("active") / F.greatest(F.col("registered"), F.lit(1)) * 100
    )


# Inactivity buckets in days.
INACTIVITY_EDGES = (7, 30, 90, 180)
INACTIVITY_LABELS = ("0-7 dias", "8-30 dias", "31-90 dias", "91-180 dias", ">180 dias (churn risk)")


def inactivity_buckets(rfm: DataFrame) -> DataFrame:
    rows = rfm.where(F.col("recency_days").isNotNull())
    return (
        rows.groupBy(bucketize("recency_days", INACTIVITY_EDGES, INACTIVITY_LABELS).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("buyers"), F.min("recency_days").alias("from_days"))
        .orderBy("from_days")
    )


def rfm_segment_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_segment").agg(
        F.count("buyer_id").alias("customer_count"),
        F.avg("monetary").alias("avg_monetary"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("recency_days").alias("avg_recency"),
    )


def top_buyers(scored: DataFrame, n: int = 20) -> DataFrame:
    return scored.orderBy(F.round("monetary", 2).desc(), "buyer_id").limit(n)


def payment_status_mix(payments: DataFrame) -> DataFrame:
    return payments.groupBy("status").agg(F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("total_amount"))


def payment_method_mix(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("status") == "CONFIRMED")
        .groupBy("method")
        .agg(F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("total_amount"))
    )


def funnel_counts(orders: DataFrame, payments: DataFrame, users: DataFrame, products: DataFrame, buyers: DataFrame) -> DataFrame:
    """Users, products, active buyers, orders, and payments by outcome in one row, one pass per table."""
    size = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return payments.agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if(F.col("status") == "CONFIRMED").alias("paid"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    ).withColumns({"orders": size(orders), "users": size(users), "products": size(products), "active_buyers": size(buyers)})


def notifications_pivot(daily: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return daily.groupBy("notif_date").pivot("event_type", list(kinds)).agg(F.sum("notifications")).na.fill(0)


def dataset_stats(
    churn: DataFrame, payments: DataFrame, demand: DataFrame, matrix: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """Sizes and positives of the training tables in one row."""
    pay = payments.agg(F.count(F.lit(1)).alias("n"), F.sum("failed_label").alias("p"))
    return churn.agg(F.count(F.lit(1)).alias("churn_rows"), F.sum("churn_label").alias("churn_positives")).withColumns(
        {
            "payment_rows": pay.select("n").scalar(),
            "payment_failures": pay.select("p").scalar(),
            "demand_days": demand.agg(F.count(F.lit(1))).scalar(),
            "interactions": matrix.agg(F.count(F.lit(1))).scalar(),
            "users": users.agg(F.count(F.lit(1))).scalar(),
            "products": products.agg(F.count(F.lit(1))).scalar(),
        }
    )


def latest_orders(orders: DataFrame, n: int = 10) -> DataFrame:
    return orders.orderBy(F.col("created_at").desc(), F.col("order_id").desc()).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table."""
    lines = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, lines)


def sales_heatmap(orders: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Orders and value by weekday (1 is Sunday) and hour."""
    rows = orders if statuses is None else sold(orders, statuses)
    return rows.groupBy(F.dayofweek("created_at").alias("dow"), F.hour("created_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("gmv")
    )
