"""Sales, customer and payment marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import first_match, fractional_days, guarded_ratio, last_days
from tidewater.operators.ranking import with_ntile

# Statuses that count as sold in the marts and in features and dashboards.
MART_SOLD = ("CREATED", "CONFIRMED", "SHIPPED", "DELIVERED")
LIVE = ("CREATED", "PAID", "CONFIRMED", "SHIPPED", "DELIVERED")


def sold(orders: DataFrame, statuses: Sequence[str] = MART_SOLD) -> DataFrame:
    return orders.where(F.col("status").isin(*statuses))


def _sales() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").alias("gmv"),
    ]


def product_metrics_daily(orders: DataFrame, products: DataFrame, statuses: Sequence[str] = MART_SOLD) -> DataFrame:
    """(day, product) sales with product attributes; the attributes join after the aggregate."""
    daily = sold(orders, statuses).groupBy(F.to_date("created_at").alias("order_date"), "product_id").agg(*_sales())
    return daily.join(products.select("product_id", "title", "category", "seller_id"), "product_id", "left")


def seller_metrics_daily(orders: DataFrame, products: DataFrame, statuses: Sequence[str] = MART_SOLD) -> DataFrame:
    """(day, seller) sales. Lines shrink to (day, product) before they meet the products."""
    daily = sold(orders, statuses).groupBy(F.to_date("created_at").alias("order_date"), "product_id").agg(*_sales())
    return (
        daily.join(products.select("product_id", "seller_id"), "product_id", "left")
        .groupBy("order_date", "seller_id")
        .agg(F.sum("orders").alias("orders"), F.sum("units_sold").alias("units_sold"), F.sum("gmv").alias("gmv"))
    )


def customer_rfm_raw(orders: DataFrame, as_of: Column, statuses: Sequence[str] = MART_SOLD) -> DataFrame:
    """Buyer: last order, frequency, monetary and recency in fractional days."""
    per_buyer = sold(orders, statuses).groupBy("buyer_id").agg(
        F.max("created_at").alias("last_order_at"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_amount").alias("monetary"),
    )
    return per_buyer.withColumn("recency_days", fractional_days("last_order_at", as_of))


def rfm_raw(orders: DataFrame, as_of: Column) -> DataFrame:
    """User: whole days since, number and value of completed orders."""
    return (
        orders.where("is_completed")
        .groupBy("user_id")
        .agg(
            F.datediff(F.to_date(as_of), F.to_date(F.max("created_at"))).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("total_amount").alias("monetary"),
        )
    )


def rfm_scores(raw: DataFrame, key: str, tiles: int = 5) -> DataFrame:
    """Quintiles of recency (most recent is 5), frequency and monetary; the key breaks ties.

    Money is compared in cents so that the order of floating point additions
    cannot move a customer across a border.
    """
    out = raw.withColumn("_cents", F.round("monetary", 2))
    out = with_ntile(out, tiles, [F.col("recency_days").desc(), F.col(key).asc()], "r_score")
    out = with_ntile(out, tiles, [F.col("frequency").asc(), F.col(key).asc()], "f_score")
    return with_ntile(out, tiles, [F.col("_cents").asc(), F.col(key).asc()], "m_score").drop("_cents")


# Both lists of segment rules, first match wins.
def mart_segments() -> list[tuple[Column, str]]:
    r, f = F.col("r_score"), F.col("f_score")
    return [
        ((r >= 4) & (f >= 4), "Champions"),
        ((r >= 3) & (f >= 3), "Loyal Customers"),
        ((r >= 4) & (f < 2), "Recent Customers"),
        ((r < 2) & (f >= 3), "At Risk"),
        ((r < 2) & (f < 2), "Lost"),
    ]


def dashboard_segments() -> list[tuple[Column, str]]:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return [
        ((r == 5) & (f >= 4), "Champions"),
        ((r >= 4) & (f >= 3), "Loyal"),
        ((r >= 3) & (m >= 4), "Big Spenders"),
        ((r == 5) & (f <= 2), "New Customers"),
        ((r <= 2) & (f >= 3), "At Risk"),
        ((r <= 2) & (f <= 2), "Hibernating"),
    ]


def customer_rfm(raw: DataFrame, key: str = "user_id") -> DataFrame:
    """Scored customers with total, cell and segment of the mart's rules."""
    scores = ("r_score", "f_score", "m_score")
    return rfm_scores(raw, key).select(
        key,
        "recency_days",
        "frequency",
        "monetary",
        *scores,
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        F.concat(*[F.col(s).cast("string") for s in scores]).alias("rfm_cell"),
        first_match(mart_segments(), "Potential Loyalists").alias("rfm_segment"),
    )


def rfm_dashboard(raw: DataFrame, users: DataFrame) -> DataFrame:
    """Scored buyers with names and the segment of the dashboard's rules."""
    names = users.select(F.col("user_id").alias("buyer_id"), "name", "email", "user_type")
    return rfm_scores(raw, "buyer_id").withColumn(
        "rfm_segment", first_match(dashboard_segments(), "Need Attention")
    ).join(names, "buyer_id", "left")


def churn_features(orders: DataFrame, as_of: Column, churn_days: int = 60) -> DataFrame:
    """User features of completed orders; label: no order for more than ``churn_days`` days."""
    day = F.to_date("created_at")
    last, first = F.max(day), F.min(day)
    today = F.to_date(as_of)
    per_user = (
        orders.where("is_completed")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("total_amount").alias("total_revenue"),
            F.avg("total_amount").alias("avg_order_value"),
            first.alias("first_order_date"),
            last.alias("last_order_date"),
            F.count_if(last_days("created_at", 30, as_of)).alias("orders_last_30d"),
            F.count_if(last_days("created_at", 90, as_of)).alias("orders_last_90d"),
            F.avg("items_count").alias("avg_items_per_order"),
        )
    )
    since = F.datediff(today, "last_order_date")
    return per_user.withColumns(
        {
            "days_since_last_order": since,
            "customer_tenure_days": F.datediff("last_order_date", "first_order_date"),
            "recency_ratio": guarded_ratio("orders_last_30d", "total_orders"),
            "churn_label": F.when(since > churn_days, 1).otherwise(0),
        }
    )


def churn_features_documented(
    orders: DataFrame, users: DataFrame, as_of: Column, returned: Sequence[str] = ("refunded",), ahead_days: int = 60
) -> DataFrame:
    """Features cut at ``as_of`` with a forward label: no order in the next ``ahead_days`` days."""
    today = F.to_date(as_of)
    day = F.to_date("created_at")
    past = day <= today
    amount = F.col("total_amount")

    def window(days: int) -> Column:
        return past & (day >= F.date_sub(today, days))

    per_user = orders.groupBy("user_id").agg(
        F.max(F.when(past, day)).alias("last_order_date"),
        F.min(F.when(past, day)).alias("first_order_date"),
        F.count_if(window(30)).alias("frequency_30d"),
        F.count_if(window(90)).alias("frequency_90d"),
        F.coalesce(F.sum(F.when(window(30), amount)), F.lit(0.0)).alias("monetary_30d"),
        F.coalesce(F.sum(F.when(window(90), amount)), F.lit(0.0)).alias("monetary_90d"),
        F.avg(F.when(past, amount)).alias("avg_order_value"),
        F.avg(F.when(past, F.col("status").isin(*returned).cast("double"))).alias("return_rate"),
        F.count_if((day > today) & (day <= F.date_add(today, ahead_days))).alias("_ahead"),
    )
    signup = users.select("user_id", F.to_date("created_at").alias("_signup"))
    recency = F.datediff(today, "last_order_date")
    tenure = F.datediff(today, "first_order_date")
    return (
        per_user.where(F.col("last_order_date").isNotNull())
        .join(signup, "user_id", "left")
        .select(
            "user_id",
            today.alias("label_date"),
            recency.alias("recency_days"),
            "frequency_30d",
            "frequency_90d",
            "monetary_30d",
            "monetary_90d",
            "avg_order_value",
            F.datediff(today, "_signup").alias("days_since_account_creation"),
            "return_rate",
            guarded_ratio(recency, tenure).alias("recency_ratio"),
            F.when(F.col("_ahead") == 0, 1).otherwise(0).alias("churn_label"),
        )
    )


def known_by(df: DataFrame, date_col: str, run_date: Column) -> DataFrame:
    """Entities whose first order lies on or before the run date."""
    return df.where(F.col(date_col) <= run_date)


def impressions_daily(events: DataFrame) -> DataFrame:
    """(day, product) clicks and distinct users, in two aggregation steps."""
    clicks = events.where((F.col("event_type") == "clicks") & F.col("product_id").isNotNull())
    per_user = clicks.groupBy("event_date", "product_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("event_date", "product_id").agg(
        F.sum("n").alias("impressions"), F.count("user_id").alias("unique_users")
    )


def product_funnel_daily(events: DataFrame, purchases: DataFrame) -> DataFrame:
    """Impressions per (day, product) with item-grain orders and revenue.

    ``purchases``: event_date, product_id, order_id, amount, one row per bought item.
    """
    per_order = purchases.where(F.col("product_id").isNotNull()).groupBy("event_date", "product_id", "order_id").agg(
        F.sum("amount").alias("amount")
    )
    bought = per_order.groupBy("event_date", "product_id").agg(
        F.count("order_id").alias("orders"), F.sum("amount").alias("revenue")
    )
    return _funnel(impressions_daily(events), bought)


def _funnel(clicks: DataFrame, bought: DataFrame) -> DataFrame:
    return (
        clicks.join(bought, ["event_date", "product_id"], "left")
        .fillna({"orders": 0, "revenue": 0.0})
        .withColumn("conversion_rate", guarded_ratio("orders", "impressions"))
    )


def purchase_fanout_daily(events: DataFrame, orders: DataFrame) -> DataFrame:
    """The funnel with orders tied to products through the user's purchase events only.

    Every order of a user counts for every product the user bought at any time:
    distinct orders per (day, product), and revenue once per purchase event.
    Both sides are reduced first, orders to one calendar vector per user and
    purchases to (user, product) counts. A vector is expanded only on days on
    which the product was clicked, so just the terms of the result are made.
    """
    clicks = impressions_daily(events)
    clicked_days = clicks.groupBy("product_id").agg(F.collect_set("event_date").alias("_days"))
    bought = (
        events.where((F.col("event_type") == "purchase") & F.col("product_id").isNotNull())
        .groupBy("user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    per_day = (
        orders.where("is_completed")
        .groupBy("user_id", F.to_date("created_at").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_orders"), F.sum("total_amount").alias("_amount"))
    )
    vectors = per_day.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_day", F.struct("_orders", "_amount")))).alias("_by_day")
    )
    terms = (
        bought.join(vectors, "user_id")
        .join(clicked_days, "product_id")
        .withColumn("event_date", F.explode(F.array_intersect(F.map_keys("_by_day"), F.col("_days"))))
        .withColumn("_term", F.col("_by_day")[F.col("event_date")])
    )
    totals = terms.groupBy("event_date", "product_id").agg(
        F.sum("_term._orders").alias("orders"), F.sum(F.col("_term._amount") * F.col("_times")).alias("revenue")
    )
    return _funnel(clicks, totals)


def notifications_daily(notifications: DataFrame) -> DataFrame:
    return notifications.groupBy(F.to_date("created_at").alias("notif_date"), "channel", "event_type").agg(
        F.count(F.lit(1)).alias("notifications")
    )


def stock_alerts(raw_events: DataFrame, schema) -> DataFrame:
    """Alert facts from raw domain events; alerts without a product are dropped, repeats are kept."""
    parsed = raw_events.withColumn("p", F.from_json("payload_json", schema))
    return parsed.where(F.col("p.product_id").isNotNull()).select("p.*", "event_ts", "event_date")


def business_metrics(orders: DataFrame, sessions: DataFrame, excluded: Sequence[str] = ("cancelled", "refunded")) -> DataFrame:
    """GMV, AOV, conversion rate and mean lifetime value in one row."""
    counted = orders.where(~F.col("status").isin(*excluded))
    per_user = counted.groupBy("user_id").agg(F.sum("total_amount").alias("ltv"), F.count(F.lit(1)).alias("n"))
    sales = per_user.agg(F.sum("ltv").alias("gmv"), F.sum("n").alias("orders"), F.avg("ltv").alias("avg_ltv"))
    visits = sessions.agg(F.avg(F.col("converted").cast("double")).alias("rate")).scalar()
    return sales.select(
        "gmv", "orders", guarded_ratio("gmv", "orders").alias("aov"), "avg_ltv", visits.alias("conversion_rate")
    )

