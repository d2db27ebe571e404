"""Feature tables and declared feature views."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import fractional_days, guarded_ratio, last_days, last_items
from tidewater.operators.asof import Source, asof_join, asof_join_many, latest_features
from tidewater.operators.joins import in_parts, lookup
from tidewater.operators.latest import require_columns
from tidewater.operators.timecells import DAY, HOUR, with_prior_totals, with_trailing_count
from tidewater.plans.marts import LIVE, sold
from tidewater.session import pin


def payments_joined(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments with the buyer of their order, null when the order is unknown."""
    buyers = orders.select(F.col("order_id").alias("_order"), F.col("user_id").alias("buyer_id"))
    return lookup(payments, buyers, "order_id", "_order", "payment_id")


def _failed() -> Column:
    return F.when(F.col("status") == "FAILED", 1.0).otherwise(0.0)


def payment_fail_rate(paid: DataFrame) -> DataFrame:
    """Buyer: number of payments, failed share, mean amount."""
    return paid.groupBy("buyer_id").agg(
        F.count(F.lit(1)).alias("payments_total"),
        F.avg(_failed()).alias("payment_fail_rate"),
        F.avg("amount").alias("avg_payment_amount"),
    )


def buyer_orders(lines: DataFrame, statuses: Sequence[str] = LIVE) -> DataFrame:
    """Buyer totals; distinct products are counted by a second aggregation, not inside the first."""
    amount = F.col("total_amount")
    per_product = sold(lines, statuses).groupBy("buyer_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("s"),
        F.count(amount).alias("c"),
        F.max("created_at").alias("hi"),
        F.min("created_at").alias("lo"),
    )
    return per_product.groupBy("buyer_id").agg(
        F.sum("n").alias("orders_total"),
        F.sum("s").alias("monetary"),
        (F.sum("s") / F.sum("c")).alias("avg_order_value"),
        F.max("hi").alias("last_order_at"),
        F.min("lo").alias("first_order_at"),
        F.count("product_id").alias("distinct_products"),
    )


def user_features(lines: DataFrame, paid: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Operational buyer features: orders, payments, recency, tenure, weekly frequency."""
    people = users.select(F.col("user_id").alias("buyer_id"), "name", "email", "user_type", F.col("created_at").alias("user_created_at"))
    out = (
        buyer_orders(lines)
        .join(payment_fail_rate(paid.where(F.col("buyer_id").isNotNull())), "buyer_id", "left")
        .join(people, "buyer_id", "left")
        .withColumn("recency_days", fractional_days("last_order_at", as_of))
        .withColumn("tenure_days", fractional_days("first_order_at", as_of))
    )
    weekly = guarded_ratio("orders_total", F.col("tenure_days") / 7.0, F.col("orders_total").cast("double"))
    defaults = {  # Fixed values: what buyers without payments or orders get
        "payments_total": 0,
        "payment_fail_rate": 0.0,
        "avg_payment_amount": 0.0,
        "distinct_products": 0,
        "orders_total": 0,
        "monetary": 0.0,
        "avg_order_value": 0.0,
    }
    return out.withColumn("frequency_per_week", weekly).fillna(defaults)


# Feature columns of the churn data set.
CHURN_FEATURES = (
    "recency_days",
    "frequency_per_week",
    "monetary",
    "avg_order_value",
    "tenure_days",
    "payment_fail_rate",
    "payments_total",
    "distinct_products",
)


def churn_dataset(features: DataFrame, days: float = 14) -> DataFrame:
    label = F.when(F.col("recency_days") > days, 1).otherwise(0)
    return features.select("buyer_id", *CHURN_FEATURES, label.alias("churn_label"))


def product_features(products: DataFrame, lines: DataFrame, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    """Product attributes with sales; ``days=None`` takes the whole history, as the column names do not say."""
    rows = sold(lines, LIVE)
    if days is not None:
        rows = rows.where(last_days("created_at", days, as_of))
    per_buyer = rows.groupBy("product_id", "buyer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"), F.sum("total_amount").alias("g")
    )
    sales = per_buyer.groupBy("product_id").agg(
        F.sum("n").alias("orders_30d"),
        F.sum("q").alias("units_30d"),
        F.sum("g").alias("gmv_30d"),
        F.count("buyer_id").alias("distinct_buyers_30d"),
    )
    zeros = {"orders_30d": 0, "units_30d": 0.0, "gmv_30d": 0.0, "distinct_buyers_30d": 0}
    return products.join(sales, "product_id", "left").fillna(zeros).select(
        "product_id", "title", "category", "price", "stock", "seller_id", *zeros
    )


def payment_dataset(paid: DataFrame) -> DataFrame:
    """Payments with hour, weekday, the buyer's whole history (this row included) and failed label."""
    history = paid.where(F.col("buyer_id").isNotNull()).groupBy("buyer_id").agg(
        F.count(F.lit(1)).alias("buyer_pay_count"),
        F.avg("amount").alias("buyer_avg_amount"),
        F.avg(_failed()).alias("buyer_fail_rate_hist"),
    )
    defaults = {"buyer_pay_count": 0, "buyer_avg_amount": 0.0, "buyer_fail_rate_hist": 0.0}
    known = lookup(paid, history.withColumnRenamed("buyer_id", "_buyer"), "buyer_id", "_buyer", "payment_id")
    return _payment_columns(known.fillna(defaults))


def payment_history_pit(paid: DataFrame) -> DataFrame:
    """The same columns, with history from the buyer's strictly earlier payments only."""
    prior = with_prior_totals(
        paid,
        "buyer_id",
        "created_at",
        ["created_at", "payment_id"],
        {"_n": F.lit(1), "_amount": F.col("amount"), "_failed": _failed()},
    )
    known = prior.withColumns(
        {
            "buyer_pay_count": F.col("_n").cast("long"),
            "buyer_avg_amount": guarded_ratio("_amount", "_n"),
            "buyer_fail_rate_hist": guarded_ratio("_failed", "_n"),
        }
    )
    return _payment_columns(known)


def _payment_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "payment_id",
        "buyer_id",
        "amount",
        "method",
        "status",
        "created_at",
        F.hour("created_at").alias("hour"),
        F.dayofweek("created_at").alias("dow"),
        "buyer_pay_count",
        "buyer_avg_amount",
        "buyer_fail_rate_hist",
        F.when(F.col("status") == "FAILED", 1).otherwise(0).alias("failed_label"),
    )


def daily_demand(lines: DataFrame) -> DataFrame:
    """Day: orders, gmv, distinct buyers, units."""
    per_buyer = sold(lines, LIVE).groupBy(F.to_date("created_at").alias("ds"), "buyer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("g"), F.sum("quantity").alias("q")
    )
    return per_buyer.groupBy("ds").agg(
        F.sum("n").alias("orders"), F.sum("g").alias("gmv"), F.count("buyer_id").alias("buyers"), F.sum("q").alias("units")
    )


def category_demand_daily(lines: DataFrame, products: DataFrame) -> DataFrame:
    """(category, day) with zero rows for days without sales.

    The grid is categories times calendar days; both are small and do not grow with the orders.
    """
    daily = sold(lines, LIVE).groupBy("product_id", F.to_date("created_at").alias("ds")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("g"), F.sum("quantity").alias("q")
    )
    totals = (
        daily.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "ds")
        .agg(F.sum("n").alias("orders"), F.sum("g").alias("gmv"), F.sum("q").alias("units"))
    )
    span = totals.agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    first, last = span.select("lo").scalar(), span.select("hi").scalar()
    grid = totals.select("category").distinct().withColumn("ds", F.explode(F.sequence(first, last)))
    return grid.join(totals, ["category", "ds"], "left").fillna({"orders": 0, "gmv": 0.0, "units": 0.0})


def user_item_matrix(lines: DataFrame, parts: int | None = None) -> DataFrame:
    return in_parts(sold(lines, LIVE), parts, "buyer_id", "product_id").groupBy("buyer_id", "product_id").agg(
        F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("gmv")
    )


def event_interactions(events: DataFrame, kinds: Sequence[str] = ("clicks", "cart", "purchase")) -> DataFrame:
    rows = events.where(
        F.col("event_type").isin(*kinds) & F.col("product_id").isNotNull() & F.col("user_id").isNotNull()
    )
    return rows.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("interaction_count"))


def matrix_stats(matrix: DataFrame, user: str, item: str) -> DataFrame:
    """Users, items, interactions, density and interactions per user of a triple table."""
    users = matrix.select(user).distinct().agg(F.count(F.lit(1))).scalar()
    items = matrix.select(item).distinct().agg(F.count(F.lit(1))).scalar()
    cells = matrix.agg(F.count(F.lit(1)).alias("interactions"))
    counted = cells.select("interactions", users.alias("users"), items.alias("items"))
    return counted.withColumns(
        {
            "density": guarded_ratio("interactions", F.col("users") * F.col("items")),
            "interactions_per_user": guarded_ratio("interactions", "users"),
        }
    )


def ml_user_features(churn: DataFrame, rfm: DataFrame) -> DataFrame:
    scores = rfm.select("user_id", "r_score", "f_score", "m_score", "rfm_total", "rfm_segment")
    return churn.select(
        "user_id",
        "total_orders",
        "total_revenue",
        "avg_order_value",
        "days_since_last_order",
        "orders_last_30d",
        "orders_last_90d",
        "avg_items_per_order",
        "customer_tenure_days",
        "recency_ratio",
    ).join(scores, "user_id", "left")


def ml_product_features(products: DataFrame, funnel: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = funnel.where(last_days("event_date", days, as_of)).groupBy("product_id").agg(
        F.sum("impressions").alias("total_impressions_30d"),
        F.sum("orders").alias("total_orders_30d"),
        F.sum("revenue").alias("total_revenue_30d"),
        F.avg("conversion_rate").alias("avg_conversion_rate_30d"),
    )
    zeros = {"total_impressions_30d": 0, "total_orders_30d": 0, "total_revenue_30d": 0.0, "avg_conversion_rate_30d": 0.0}
    return products.select("product_id", "price", "stock", "brand", "category").join(recent, "product_id", "left").fillna(zeros)


def ml_session_features(sessions: DataFrame, min_length: int = 2) -> DataFrame:
    """Sessions long enough to train on, with length, start hour and weekday."""
    return sessions.where(F.size("product_sequence") >= min_length).withColumns(
        {
            "sequence_length": F.size("product_sequence"),
            "start_hour": F.hour("session_start"),
            "start_day_of_week": F.dayofweek("session_start"),
        }
    )


def training_sequences(sessions: DataFrame, min_length: int = 2, max_items: int = 50, limit: int | None = None) -> DataFrame:
    """Item sequences without nulls, cut to the model's input window; ``limit`` asks for so many sessions only."""
    items = sessions.select("session_sk", "user_id", F.array_compact("product_sequence").alias("items"))
    out = items.where(F.size("items") >= min_length).withColumn("items", last_items("items", max_items))
    return out if limit is None else out.limit(limit)


def fraud_features(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Order: amount, items, hour, account age, orders in the last hour, deviation from the buyer's past.

    The deviation is (amount - mean) / standard deviation over the user's
    earlier orders, 0 while there is no spread to compare with.
    """
    amount = F.col("total_amount")
    first = orders.groupBy("user_id").agg(F.min_by("total_amount", F.struct("created_at", "order_id")).alias("_first"))
    rows = with_trailing_count(orders, "user_id", "created_at", HOUR, "orders_in_last_hour").join(first, "user_id", "left")
    # Measured from the user's first amount, sums of squares do not cancel out.
    offset = amount - F.coalesce("_first", F.lit(0.0))
    rows = with_prior_totals(
        rows,
        "user_id",
        "created_at",
        ["created_at", "order_id"],
        {"_n": F.lit(1), "_sum": offset, "_squares": offset * offset},
        DAY,
    )
    mean = F.try_divide("_sum", "_n")
    variance = F.greatest(F.try_divide("_squares", "_n") - mean * mean, F.lit(0.0))
    signup = users.select("user_id", F.to_date("created_at").alias("_signup"))
    deviation = F.when((F.col("_n") > 1) & (variance > 1e-6), F.try_divide(offset - mean, F.sqrt(variance))).otherwise(F.lit(0.0))
    return rows.join(signup, "user_id", "left").select(
        "order_id",
        "user_id",
        amount.alias("total_amount"),
        "items_count",
        F.hour("created_at").alias("hour_of_day"),
        F.datediff(F.to_date("created_at"), "_signup").alias("days_since_account_creation"),
        "orders_in_last_hour",
        deviation.alias("avg_order_value_deviation"),
    )


@dataclass(frozen=True)
class FeatureView:
    """A declared feature view: entity key, event time, lifetime, features of a source table."""

    name: str
    entity: str
    event_time: str
    ttl_seconds: int
    features: tuple[str, ...]

    def check(self, source: DataFrame) -> None:
        require_columns(source, [self.entity, self.event_time, *self.features], f"feature view {self.name}")

    def historical(self, spine: DataFrame, spine_time: str, source: DataFrame) -> DataFrame:
        """Point-in-time values for each spine row."""
        self.check(source)
        return asof_join(spine, source, self.entity, spine_time, self.event_time, self.features, self.ttl_seconds)

    def latest(self, source: DataFrame, ids: DataFrame | None = None) -> DataFrame:
        """Newest values per entity."""
        self.check(source)
        return latest_features(source.select(self.entity, self.event_time, *self.features), self.entity, self.event_time, ids)


def historical_features(spine: DataFrame, spine_time: str, views: Sequence[tuple[FeatureView, DataFrame]]) -> DataFrame:
    """Point-in-time values of several views (with their source tables): one pass over the spine per entity key.

    The features are pinned: the join reads them twice, and they may be the end of long plans.
    """
    out = spine
    for entity in dict.fromkeys(view.entity for view, _ in views):
        sources = []
        for view, source in views:
            if view.entity == entity:
                view.check(source)
                rows = pin(source.select(*dict.fromkeys([view.entity, view.event_time, *view.features])))
                sources.append(Source(view.name, rows, view.event_time, view.features, view.ttl_seconds))
        out = asof_join_many(out, sources, entity, spine_time, whole=True)
    return out


# Lifetimes of the declared views, features named as in the tables here.
USER_CHURN_VIEW = FeatureView(
    "user_churn_features",
    "user_id",
    "label_date",
    7 * DAY,
    (
        "recency_days",
        "frequency_30d",
        "frequency_90d",
        "monetary_30d",
        "monetary_90d",
        "avg_order_value",
        "days_since_account_creation",
        "return_rate",
        "recency_ratio",
        "churn_label",
    ),
)
USER_RFM_VIEW = FeatureView(
    "user_rfm_features",
    "user_id",
    "snapshot_date",
    DAY,
    ("recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_segment"),
)
PRODUCT_VIEW = FeatureView("product_features", "product_id", "updated_at", DAY, ("title", "category", "price", "stock"))
SESSION_VIEW = FeatureView(
    "session_features",
    "user_id",
    "session_end",
    2 * HOUR,
    ("session_id", "event_count", "duration_seconds", "converted"),
)


def demand_windows(series: DataFrame, value: str, lookback: int, horizon: int, date: str = "ds") -> DataFrame:
    """Full (look-back, horizon) windows over a daily series: n - lookback - horizon + 1 rows.

    The series has one row per calendar day, so the single ordered window is bounded by the calendar.
    """
    timeline = Window.orderBy(date)
    past = F.collect_list(value).over(timeline.rowsBetween(-(lookback - 1), 0))
    ahead = F.collect_list(value).over(timeline.rowsBetween(1, horizon))
    both = series.select(F.col(date).alias("window_end"), past.alias("inputs"), ahead.alias("targets"))
    return both.where((F.size("inputs") == lookback) & (F.size("targets") == horizon))


def last_window(series: DataFrame, n: int, date: str = "ds") -> DataFrame:
    """The last ``n`` rows of a daily series, front-padded by repeating its last row."""
    tail = series.orderBy(F.col(date).desc()).limit(n)
    ordered = tail.agg(F.array_sort(F.collect_list(F.struct(date, *[c for c in series.columns if c != date]))).alias("rows"))
    gap = F.greatest(F.lit(n) - F.size("rows"), F.lit(0))
    padded = F.concat(F.array_repeat(F.element_at("rows", -1), gap), F.col("rows"))
    return ordered.select(F.posexplode(padded).alias("position", "row")).select("position", "row.*")


def scaled(series: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns centred and divided by their population deviation, 1 where there is none."""
    stats = series.agg(
        *[F.avg(c).alias(f"mu_{c}") for c in columns], *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns]
    )
    def z(c: str) -> Column:
        mu, sd = stats.select(f"mu_{c}").scalar(), stats.select(f"sd_{c}").scalar()
        return (F.col(c) - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)

    return series.withColumns({f"{c}_z": z(c) for c in columns})

