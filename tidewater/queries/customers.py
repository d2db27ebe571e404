"""Customer marts: recency-frequency-monetary, churn, activity."""

from pyspark.sql import functions as F

from tidewater.plans import dashboards as D
from tidewater.plans import marts as M
from tidewater.queries.oracle import sql
from tidewater.queries.registry import as_of, query, rounded


def raw(c):
    return M.customer_rfm_raw(c.order_lines(), as_of(c.orders()))


def completed(c):
    return c.orders().withColumn("is_completed", F.col("status") == "completed")


@query(
    "customer_rfm_raw",
    sql("rfmraw", "SELECT buyer_id, last_order_at, frequency, round(monetary, 2) AS monetary, CAST(recency_days AS DOUBLE) AS recency_days FROM rfmraw"),
)
def customer_rfm_raw(c):
    return rounded(raw(c), monetary=2)


@query(
    "rfm_scores",
    sql(
        "rfmmart",
        "SELECT user_id, recency_days, frequency, round(monetary, 2) AS monetary, r_score, f_score, m_score, "
        "rfm_total, rfm_cell, rfm_segment FROM rfmmart",
    ),
    ints="recency_days",
)
def rfm_scores(c):
    orders = completed(c)
    return rounded(M.customer_rfm(M.rfm_raw(orders, as_of(orders))), monetary=2)


@query(
    "rfm_dashboard",
    sql(
        "rfmdash users",
        "SELECT buyer_id, name, email, user_type, CAST(recency_days AS DOUBLE) AS recency_days, frequency, "
        "round(monetary, 2) AS monetary, rfm_segment FROM rfmdash LEFT JOIN users ON user_id = buyer_id",
    ),
)
def rfm_dashboard(c):
    out = M.rfm_dashboard(raw(c), c.users()).select(
        "buyer_id", "name", "email", "user_type", "recency_days", "frequency", "monetary", "rfm_segment"
    )
    return rounded(out, monetary=2)


@query(
    "rfm_segment_summary",
    sql(
        "rfmdash",
        "SELECT rfm_segment, count(*) AS customer_count, round(avg(monetary) + 1e-9, 4) AS avg_monetary, "
        "round(avg(frequency) + 1e-9, 6) AS avg_frequency, round(avg(recency_days) + 1e-9, 6) AS avg_recency FROM rfmdash GROUP BY ALL",
    ),
)
def rfm_segment_summary(c):
    out = D.rfm_segment_summary(M.rfm_dashboard(raw(c), c.users()))
    return rounded(out, avg_monetary=4, avg_frequency=6, avg_recency=6)


@query(
    "top_buyers",
    sql(
        "rfmraw users",
        "SELECT buyer_id, name, frequency, round(monetary, 2) AS monetary FROM rfmraw LEFT JOIN users ON user_id = buyer_id "
        "ORDER BY monetary DESC, buyer_id LIMIT 20",
    ),
)
def top_buyers(c):
    names = c.users().select(F.col("user_id").alias("buyer_id"), "name")
    best = D.top_buyers(raw(c)).join(names, "buyer_id", "left")
    return rounded(best.select("buyer_id", "name", "frequency", "monetary"), monetary=2)


@query(
    "inactivity_buckets",
    sql(
        "rfmraw",
        "SELECT CASE WHEN recency_days <= 7 THEN '0-7 dias' WHEN recency_days <= 30 THEN '8-30 dias' WHEN recency_days <= 90 "
        "THEN '31-90 dias' WHEN recency_days <= 180 THEN '91-180 dias' ELSE '>180 dias (churn risk)' END AS bucket, "
        "count(*) AS buyers, CAST(min(recency_days) AS DOUBLE) AS from_days FROM rfmraw GROUP BY 1",
    ),
)
def inactivity_buckets(c):
    return D.inactivity_buckets(raw(c))


@query(
    "active_buyer_share",
    sql(
        "cutoff sold users",
        "SELECT count(*) AS registered, (SELECT count(*) FROM act) AS active, "
        "round((SELECT count(*) FROM act) / greatest(count(*), 1) * 100.0 + 1e-9, 6) AS active_pct FROM users WHERE user_type = 'BUYER'",
        "act AS (SELECT DISTINCT buyer_id FROM sold JOIN users ON user_id = buyer_id "
        "WHERE user_type = 'BUYER' AND CAST(sold.created_at AS DATE) >= (SELECT d FROM cutoff) - 365)",
    ),
)
def active_buyer_share(c):
    registered = c.users().where("user_type = 'BUYER'").select(F.col("user_id").alias("buyer_id"))
    since = F.date_sub(F.to_date(as_of(c.orders())), 365)
    recent = M.sold(c.order_lines()).where(F.to_date("created_at") >= since).select("buyer_id").distinct()
    return rounded(D.active_buyer_share(c.users(), recent.join(registered, "buyer_id", "left_semi")), active_pct=6)


@query("distinct_buyers", sql("sold", "SELECT DISTINCT buyer_id FROM sold"))
def distinct_buyers(c):
    return M.sold(c.order_lines()).select("buyer_id").distinct()


_CHURN = (
    "user_id, total_orders, round(total_revenue, 2) AS total_revenue, round(avg_order_value + 1e-9, 4) AS avg_order_value, "
    "first_order_date, last_order_date, days_since_last_order, orders_last_30d, orders_last_90d, "
    "round(avg_items_per_order + 1e-9, 6) AS avg_items_per_order, customer_tenure_days, round(recency_ratio + 1e-9, 6) AS recency_ratio, churn_label"
)


def churn(c):
    orders = completed(c)
    return M.churn_features(orders, as_of(orders))


@query("churn_features", sql("churn", f"SELECT {_CHURN} FROM churn"), ints="days_since_last_order customer_tenure_days")
def churn_features(c):
    return rounded(churn(c), total_revenue=2, avg_order_value=4, avg_items_per_order=6, recency_ratio=6)


@query(
    "churn_features_cutoff",
    sql("churn", f"SELECT {_CHURN} FROM churn WHERE first_order_date <= DATE '1996-06-30'"),
    ints="days_since_last_order customer_tenure_days",
)
def churn_features_cutoff(c):
    known = M.known_by(churn(c), "first_order_date", F.lit("1996-06-30").cast("date"))
    return rounded(known, total_revenue=2, avg_order_value=4, avg_items_per_order=6, recency_ratio=6)


@query(
    "churn_features_doc",
    sql(
        "heads users",
        """SELECT user_id, DATE '2000-01-01' AS label_date, date_diff('day', l, DATE '2000-01-01') AS recency_days, frequency_30d, frequency_90d,
        round(monetary_30d, 2) AS monetary_30d, round(monetary_90d, 2) AS monetary_90d, round(avg_order_value + 1e-9, 4) AS avg_order_value,
        date_diff('day', CAST(u.created_at AS DATE), DATE '2000-01-01') AS days_since_account_creation, round(return_rate + 1e-9, 6) AS return_rate,
        round(CASE WHEN date_diff('day', f, DATE '2000-01-01') > 0 THEN date_diff('day', l, DATE '2000-01-01') / date_diff('day', f, DATE '2000-01-01') ELSE 0 END + 1e-9, 6) AS recency_ratio,
        CASE WHEN ahead = 0 THEN 1 ELSE 0 END AS churn_label
        FROM (SELECT user_id, max(d) FILTER (past) AS l, min(d) FILTER (past) AS f,
              count(*) FILTER (past AND d >= DATE '2000-01-01' - 30) AS frequency_30d, count(*) FILTER (past AND d >= DATE '2000-01-01' - 90) AS frequency_90d,
              coalesce(sum(total_amount) FILTER (past AND d >= DATE '2000-01-01' - 30), 0) AS monetary_30d,
              coalesce(sum(total_amount) FILTER (past AND d >= DATE '2000-01-01' - 90), 0) AS monetary_90d,
              avg(total_amount) FILTER (past) AS avg_order_value,
              avg(CASE WHEN status = 'pending' THEN 1.0 ELSE 0.0 END) FILTER (past) AS return_rate,
              count(*) FILTER (NOT past AND d <= DATE '2000-01-01' + 60) AS ahead
              FROM (SELECT *, CAST(created_at AS DATE) AS d, CAST(created_at AS DATE) <= DATE '2000-01-01' AS past FROM heads) GROUP BY user_id)
        LEFT JOIN users u USING (user_id) WHERE l IS NOT NULL""",
    ),
    ints="recency_days days_since_account_creation",
)
def churn_features_doc(c):
    day = F.lit("2000-01-01").cast("timestamp")
    out = M.churn_features_documented(c.orders(), c.users(), day, returned=("pending",))
    return rounded(out, monetary_30d=2, monetary_90d=2, avg_order_value=4, return_rate=6, recency_ratio=6)
