"""Payment marts and feature tables."""

from pyspark.sql import functions as F

from tidewater.operators.asof import latest_features
from tidewater.operators.ranking import top_per_group
from tidewater.operators.sessions import session_facts
from tidewater.operators.timecells import DAY
from tidewater.plans import dashboards as D
from tidewater.plans import features as FE
from tidewater.plans import marts as M
from tidewater.plans.star import fact_sessions
from tidewater.queries import customers as CU
from tidewater.queries.oracle import sessions_sql, sql
from tidewater.queries.registry import as_of, joined, oracle_of, query, rounded


def paid(c):
    return FE.payments_joined(c.payments(), c.orders())


@query("payments_joined", sql("pays", "SELECT payment_id, order_id, buyer_id, amount, method, status, created_at FROM pays"))
def payments_joined(c):
    return paid(c)


@query(
    "payment_fail_rate",
    sql(
        "pays",
        "SELECT buyer_id, count(*) AS payments_total, round(sum(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END) / count(*) + 1e-9, 6) AS payment_fail_rate, "
        "round(avg(amount) + 1e-9, 4) AS avg_payment_amount FROM pays GROUP BY buyer_id",
    ),
)
def payment_fail_rate(c):
    return rounded(FE.payment_fail_rate(paid(c)), payment_fail_rate=6, avg_payment_amount=4)


@query(
    "payments_by_day",
    sql(
        "pays",
        "SELECT CAST(created_at AS DATE) AS pay_date, count(*) AS attempts, count(*) FILTER (status = 'CONFIRMED') AS confirmed, "
        "count(*) FILTER (status = 'FAILED') AS failed, round(count(*) FILTER (status = 'CONFIRMED') / count(*) * 100 + 1e-9, 6) AS confirmed_pct "
        "FROM pays GROUP BY ALL",
    ),
)
def payments_by_day(c):
    return rounded(D.payments_by_day(c.payments()), confirmed_pct=6)


@query(
    "payment_status_mix",
    sql("pays", "SELECT status, count(*) AS payments, round(sum(amount), 2) AS total_amount FROM pays GROUP BY ALL"),
)
def payment_status_mix(c):
    return rounded(D.payment_status_mix(c.payments()), total_amount=2)


@query(
    "payment_method_mix",
    sql("pays", "SELECT method, count(*) AS payments, round(sum(amount), 2) AS total_amount FROM pays WHERE status = 'CONFIRMED' GROUP BY ALL"),
)
def payment_method_mix(c):
    return rounded(D.payment_method_mix(c.payments()), total_amount=2)


@query(
    "funnel_counts",
    sql(
        "lines pays rfmraw users products",
        "SELECT (SELECT count(*) FROM lines) AS orders, (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM products) AS products, "
        "(SELECT count(*) FROM rfmraw) AS active_buyers, count(*) AS payments, count(*) FILTER (status = 'CONFIRMED') AS paid, "
        "count(*) FILTER (status = 'FAILED') AS failed FROM pays",
    ),
)
def funnel_counts(c):
    lines = c.order_lines()
    return D.funnel_counts(lines, c.payments(), c.users(), c.products(), M.customer_rfm_raw(lines, as_of(c.orders())))


_UF = {"monetary": 2, "avg_order_value": 4, "payment_fail_rate": 6, "avg_payment_amount": 4, "recency_days": 6, "tenure_days": 6, "frequency_per_week": 6}
_UF_SQL = (
    "round(monetary, 2) AS monetary, round(avg_order_value + 1e-9, 4) AS avg_order_value, round(payment_fail_rate + 1e-9, 6) AS payment_fail_rate, "
    "round(recency_days + 1e-9, 6) AS recency_days, round(tenure_days + 1e-9, 6) AS tenure_days, round(frequency_per_week + 1e-9, 6) AS frequency_per_week, "
    "payments_total, distinct_products"
)


def user_feature_table(c):
    return FE.user_features(c.order_lines(), paid(c), c.users(), as_of(c.orders()))


@query(
    "user_features",
    sql(
        "ufeat",
        f"SELECT buyer_id, orders_total, last_order_at, first_order_at, {_UF_SQL}, round(avg_payment_amount + 1e-9, 4) AS avg_payment_amount, "
        "name, email, user_type, user_created_at FROM ufeat",
    ),
)
def user_features(c):
    return rounded(user_feature_table(c), **_UF)


@query(
    "churn_dataset",
    sql("ufeat", f"SELECT buyer_id, {_UF_SQL}, CASE WHEN recency_days > 14 THEN 1 ELSE 0 END AS churn_label FROM ufeat"),
)
def churn_dataset(c):
    out = FE.churn_dataset(user_feature_table(c))
    return rounded(out, **{k: v for k, v in _UF.items() if k != "avg_payment_amount"})


@query(
    "product_features",
    sql(
        "live products",
        "SELECT product_id, title, category, price, stock, seller_id, coalesce(o, 0) AS orders_30d, coalesce(u, 0) AS units_30d, "
        "round(coalesce(g, 0), 2) AS gmv_30d, coalesce(b, 0) AS distinct_buyers_30d FROM products LEFT JOIN "
        "(SELECT product_id, count(*) AS o, sum(quantity) AS u, sum(total_amount) AS g, count(DISTINCT buyer_id) AS b FROM live GROUP BY ALL) USING (product_id)",
    ),
)
def product_features(c):
    return rounded(FE.product_features(c.products(), c.order_lines()), gmv_30d=2)


@query(
    "product_features_30d",
    sql(
        "cutoff live products",
        "SELECT product_id, title, category, price, stock, seller_id, coalesce(o, 0) AS orders_30d, coalesce(u, 0) AS units_30d, "
        "round(coalesce(g, 0), 2) AS gmv_30d, coalesce(b, 0) AS distinct_buyers_30d FROM products LEFT JOIN "
        "(SELECT product_id, count(*) AS o, sum(quantity) AS u, sum(total_amount) AS g, count(DISTINCT buyer_id) AS b FROM live "
        "WHERE CAST(created_at AS DATE) >= (SELECT d FROM cutoff) - 30 GROUP BY ALL) USING (product_id)",
    ),
)
def product_features_30d(c):
    return rounded(FE.product_features(c.products(), c.order_lines(), 30, as_of(c.orders())), gmv_30d=2)


_PAY = (
    "payment_id, buyer_id, amount, method, status, created_at, hour, dow, buyer_pay_count, "
    "round(buyer_avg_amount + 1e-9, 4) AS buyer_avg_amount, round(buyer_fail_rate_hist + 1e-9, 6) AS buyer_fail_rate_hist, failed_label"
)


@query("payment_dataset", sql("paydata", f"SELECT {_PAY} FROM paydata"), ints="hour dow")
def payment_dataset(c):
    return rounded(FE.payment_dataset(paid(c)), buyer_avg_amount=4, buyer_fail_rate_hist=6)


@query(
    "payment_history_pit",
    sql(
        "pays",
        f"SELECT {_PAY} FROM (SELECT *, hour(created_at) AS hour, dayofweek(created_at) + 1 AS dow, "
        "CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS failed_label, "
        "CASE WHEN buyer_id IS NULL THEN 0 ELSE count(*) OVER w END AS buyer_pay_count, "
        "CASE WHEN buyer_id IS NULL THEN 0 ELSE coalesce(avg(amount) OVER w, 0) END AS buyer_avg_amount, "
        "CASE WHEN buyer_id IS NULL THEN 0 ELSE coalesce(avg(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END) OVER w, 0) END AS buyer_fail_rate_hist "
        "FROM pays WINDOW w AS (PARTITION BY buyer_id ORDER BY created_at, payment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
    ),
    ints="hour dow",
)
def payment_history_pit(c):
    return rounded(FE.payment_history_pit(paid(c)), buyer_avg_amount=4, buyer_fail_rate_hist=6)


@query(
    "user_item_matrix",
    sql("matrix", "SELECT buyer_id, product_id, units, orders, round(gmv, 2) AS gmv FROM matrix"),
)
def user_item_matrix(c):
    return rounded(FE.user_item_matrix(c.order_lines()), gmv=2)


@query(
    "matrix_stats",
    sql(
        "matrix",
        "SELECT count(*) AS interactions, count(DISTINCT buyer_id) AS users, count(DISTINCT product_id) AS items, "
        "round(count(*) / (count(DISTINCT buyer_id) * count(DISTINCT product_id)) + 1e-9, 8) AS density, "
        "round(count(*) / count(DISTINCT buyer_id) + 1e-9, 6) AS interactions_per_user FROM matrix",
    ),
)
def matrix_stats(c):
    out = FE.matrix_stats(FE.user_item_matrix(c.order_lines()), "buyer_id", "product_id")
    return rounded(out, density=8, interactions_per_user=6)


@query(
    "event_interactions",
    sql(
        "ev",
        "SELECT user_id, product_id, count(*) AS interaction_count FROM ev WHERE event_type IN ('clicks','cart','purchase') "
        "AND product_id IS NOT NULL GROUP BY ALL",
    ),
)
def event_interactions(c):
    return FE.event_interactions(c.events())


@query(
    "ml_user_features",
    sql(
        "churn rfmmart",
        "SELECT user_id, total_orders, round(total_revenue, 2) AS total_revenue, round(avg_order_value + 1e-9, 4) AS avg_order_value, "
        "days_since_last_order, orders_last_30d, orders_last_90d, round(avg_items_per_order + 1e-9, 6) AS avg_items_per_order, "
        "customer_tenure_days, round(recency_ratio + 1e-9, 6) AS recency_ratio, r_score, f_score, m_score, rfm_total, rfm_segment "
        "FROM churn LEFT JOIN (SELECT user_id, r_score, f_score, m_score, rfm_total, rfm_segment FROM rfmmart) USING (user_id)",
    ),
    ints="days_since_last_order customer_tenure_days",
)
def ml_user_features(c):
    orders = CU.completed(c)
    today = as_of(orders)
    out = FE.ml_user_features(M.churn_features(orders, today), M.customer_rfm(M.rfm_raw(orders, today)))
    return rounded(out, total_revenue=2, avg_order_value=4, avg_items_per_order=6, recency_ratio=6)


@query(
    "ml_product_features",
    sql(
        "funnel products",
        "SELECT product_id, price, stock, brand, category, CAST(coalesce(i, 0) AS BIGINT) AS total_impressions_30d, "
        "CAST(coalesce(o, 0) AS BIGINT) AS total_orders_30d, round(coalesce(r, 0), 2) AS total_revenue_30d, "
        "round(coalesce(v, 0) + 1e-9, 6) AS avg_conversion_rate_30d FROM products LEFT JOIN "
        "(SELECT product_id, sum(impressions) AS i, sum(orders) AS o, sum(revenue) AS r, avg(conversion_rate) AS v FROM funnel "
        "WHERE event_date >= (SELECT max(event_date) FROM ev) - 30 GROUP BY ALL) USING (product_id)",
    ),
)
def ml_product_features(c):
    events = c.events()
    bought = events.where("event_type = 'purchase'").select(
        "event_date", "product_id", F.col("event_id").alias("order_id"), F.col("value").alias("amount")
    )
    funnel = M.product_funnel_daily(events, bought)
    out = FE.ml_product_features(c.products(), funnel, events.agg(F.max("event_date")).scalar())
    return rounded(out, total_revenue_30d=2, avg_conversion_rate_30d=6)


@query(
    "ml_session_features",
    sql(
        "ev",
        "SELECT session_sk, session_id, user_id, session_start, duration_seconds, event_count, distinct_products_viewed, cart_actions, "
        "converted, product_sequence, event_count AS sequence_length, hour(session_start) AS start_hour, dayofweek(session_start) + 1 AS start_day_of_week "
        "FROM sess WHERE event_count >= 2",
        sessions_sql(720),
    ),
    ints="sequence_length start_hour start_day_of_week",
)
def ml_session_features(c):
    out = FE.ml_session_features(session_facts(c.events(), 720))
    return out.withColumn("product_sequence", joined("product_sequence")).drop("session_num", "session_end", "purchases")


@query(
    "fraud_velocity",
    sql(
        "pays",
        "SELECT payment_id, buyer_id, created_at, count(*) OVER (PARTITION BY buyer_id ORDER BY created_at "
        "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS payments_in_window FROM pays",
    ),
)
def fraud_velocity(c):
    from tidewater.operators.timecells import with_trailing_count

    rows = paid(c).select("payment_id", "buyer_id", "created_at")
    return with_trailing_count(rows, "buyer_id", "created_at", 30 * DAY, "payments_in_window")


@query(
    "fraud_features",
    sql(
        "heads users",
        """SELECT order_id, user_id, total_amount, items_count, hour(h.created_at) AS hour_of_day,
        date_diff('day', CAST(u.created_at AS DATE), CAST(h.created_at AS DATE)) AS days_since_account_creation, orders_in_last_hour,
        round(CASE WHEN n > 1 AND v > 1e-6 THEN (total_amount - m) / sqrt(v) ELSE 0 END + 1e-9, 4) + 0.0 AS avg_order_value_deviation
        FROM (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY created_at RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS orders_in_last_hour,
                     count(*) OVER w AS n, avg(total_amount) OVER w AS m, var_pop(total_amount) OVER w AS v
              FROM heads WINDOW w AS (PARTITION BY user_id ORDER BY created_at, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) h
        LEFT JOIN users u USING (user_id)""",
    ),
    ints="hour_of_day days_since_account_creation",
)
def fraud_features(c):
    return rounded(FE.fraud_features(c.orders(), c.users()), avg_order_value_deviation=4)


def feature_log(c):
    """Features computed at each purchase: (user, time, value)."""
    return c.events().where("event_type = 'purchase'").select(
        "user_id", F.col("event_ts").alias("feature_time"), F.col("event_id").alias("feature_id"), F.col("value").alias("last_value")
    )


@query(
    "asof_feature_join",
    sql(
        "ev",
        "SELECT e.event_id, e.user_id, e.event_ts, "
        "CASE WHEN f.event_ts >= e.event_ts - INTERVAL 1 DAY THEN f.event_ts END AS feature_ts, "
        "CASE WHEN f.event_ts >= e.event_ts - INTERVAL 1 DAY THEN f.event_id END AS feature_id, "
        "CASE WHEN f.event_ts >= e.event_ts - INTERVAL 1 DAY THEN f.value END AS last_value "
        "FROM (SELECT * FROM ev WHERE event_type = 'clicks') e ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'purchase') f "
        "ON e.user_id = f.user_id AND e.event_ts >= f.event_ts",
    ),
)
def asof_feature_join(c):
    view = FE.FeatureView("purchases", "user_id", "feature_time", DAY, ("feature_id", "last_value"))
    spine = c.events().where("event_type = 'clicks'").select("event_id", "user_id", "event_ts")
    return view.historical(spine, "event_ts", feature_log(c))


_VIEWS = {
    "churn": ("user_id", "label_date", "7 DAY", FE.USER_CHURN_VIEW),
    "rfm": ("user_id", "snapshot_date", "1 DAY", FE.USER_RFM_VIEW),
    "session": ("user_id", "session_end", "2 HOUR", FE.SESSION_VIEW),
    "product": ("product_id", "updated_at", "1 DAY", FE.PRODUCT_VIEW),
}


def _historical_sql():
    joins, columns = [], ["s.event_id", "s.user_id", "s.product_id", "s.event_ts"]
    for name, (key, ts, ttl, view) in _VIEWS.items():
        joins.append(f"ASOF LEFT JOIN {name}_rows {name} ON s.{key} = {name}.{key} AND s.event_ts >= {name}.{ts}")
        columns += [f"CASE WHEN {name}.{ts} >= s.event_ts - INTERVAL {ttl} THEN {name}.{c} END AS {view.name}__{'ts' if c == ts else c}" for c in (ts, *view.features)]
    days = "(SELECT unnest([TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-20']) AS snap)"
    known = f"""churn_rows AS (SELECT * EXCLUDE (snap, label_date), snap AS label_date FROM ({oracle_of("churn_features_doc")}), {days}),
        rfm_rows AS (SELECT *, snap AS snapshot_date FROM ({oracle_of("rfm_scores")}), {days}),
        product_rows AS (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(product_id % 20 AS INTEGER)) AS updated_at FROM products),
        session_rows AS (SELECT * FROM sess)"""
    return sql("ev products", f"SELECT {', '.join(columns)} FROM (SELECT * FROM ev WHERE event_type = 'clicks') s {' '.join(joins)}", f"{sessions_sql(30)}, {known}")


@query("historical_features", _historical_sql())
def historical_features(c):
    """Clicks with what the four declared views knew at the time: two passes, one by user for three views, one by product."""
    days = F.explode(F.array(*[F.lit(d).cast("timestamp") for d in ("2024-01-03", "2024-01-12", "2024-01-20")]))
    products = c.products().withColumn("updated_at", F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("product_id") % 20).cast("int")))
    sources = [
        (FE.USER_CHURN_VIEW, CU.churn_features_doc(c).drop("label_date").withColumn("label_date", days)),
        (FE.USER_RFM_VIEW, CU.rfm_scores(c).withColumn("snapshot_date", days)),
        (FE.SESSION_VIEW, fact_sessions(c.events(), with_sequence=False)),
        (FE.PRODUCT_VIEW, products),
    ]
    spine = c.events().where("event_type = 'clicks'").select("event_id", "user_id", "product_id", "event_ts")
    return FE.historical_features(spine, "event_ts", sources)


@query(
    "latest_features",
    sql(
        "ev",
        "SELECT user_id, max(event_ts) AS feature_time, arg_max(event_id, event_ts) AS feature_id, arg_max(value, event_ts) AS last_value "
        "FROM ev WHERE event_type = 'purchase' GROUP BY user_id",
    ),
)
def latest(c):
    return latest_features(feature_log(c), "user_id", "feature_time")


@query(
    "top_items_per_user",
    sql(
        "matrix",
        "SELECT buyer_id, product_id, units, rank FROM (SELECT *, row_number() OVER (PARTITION BY buyer_id ORDER BY units DESC, product_id) AS rank "
        "FROM matrix) WHERE rank <= 5",
    ),
    ints="rank",
)
def top_items_per_user(c):
    triples = FE.user_item_matrix(c.order_lines()).select("buyer_id", "product_id", "units")
    return top_per_group(triples, ["buyer_id"], [F.col("units").desc(), F.col("product_id")], 5)


@query(
    "dataset_stats",
    sql(
        "ufeat paydata demand matrix",
        "SELECT count(*) AS churn_rows, CAST(sum(CASE WHEN recency_days > 14 THEN 1 ELSE 0 END) AS BIGINT) AS churn_positives, "
        "(SELECT count(*) FROM paydata) AS payment_rows, (SELECT CAST(sum(failed_label) AS BIGINT) FROM paydata) AS payment_failures, "
        "(SELECT count(*) FROM demand) AS demand_days, (SELECT count(*) FROM matrix) AS interactions, "
        "(SELECT count(*) FROM ufeat) AS users, (SELECT count(*) FROM part) AS products FROM ufeat",
    ),
)
def dataset_stats(c):
    lines = c.order_lines()
    users, products = user_feature_table(c), FE.product_features(c.products(), lines)
    return D.dataset_stats(FE.churn_dataset(users), FE.payment_dataset(paid(c)), FE.daily_demand(lines), FE.user_item_matrix(lines), users, products)


def notifications(c):
    """One notification per sign-up or error event."""
    return c.table("events").where("event_type IN ('signup', 'error')").select(
        F.col("event_id").alias("notif_id"),
        "user_id",
        F.when(F.col("event_id") % 2 == 0, "email").otherwise("push").alias("channel"),
        F.col("event_type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


@query(
    "notifications_daily",
    "SELECT CAST(ts AS DATE) AS notif_date, CASE WHEN event_id % 2 = 0 THEN 'email' ELSE 'push' END AS channel, event_type, "
    "count(*) AS notifications FROM events WHERE event_type IN ('signup', 'error') GROUP BY ALL",
)
def notifications_daily(c):
    return M.notifications_daily(notifications(c))


@query(
    "notifications_pivot",
    "SELECT CAST(ts AS DATE) AS notif_date, count(*) FILTER (event_type = 'signup') AS signup, "
    "count(*) FILTER (event_type = 'error') AS error FROM events WHERE event_type IN ('signup', 'error') GROUP BY ALL",
)
def notifications_pivot(c):
    return D.notifications_pivot(M.notifications_daily(notifications(c)), ("signup", "error"))


@query(
    "demand_windows",
    sql(
        "demand",
        "SELECT ds AS window_end, round(s, 2) AS input_sum, round(t, 2) AS target_sum FROM (SELECT ds, "
        "sum(gmv) OVER (ORDER BY ds ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS s, count(*) OVER (ORDER BY ds ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS n, "
        "sum(gmv) OVER (ORDER BY ds ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS t, count(*) OVER (ORDER BY ds ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS m "
        "FROM demand) WHERE n = 90 AND m = 14",
    ),
)
def demand_windows(c):
    windows = FE.demand_windows(FE.daily_demand(c.order_lines()), "gmv", 90, 14)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    out = windows.select("window_end", total("inputs").alias("input_sum"), total("targets").alias("target_sum"))
    return rounded(out, input_sum=2, target_sum=2)


@query(
    "demand_last_window",
    sql("demand", "SELECT CAST(row_number() OVER (ORDER BY ds) - 1 AS INTEGER) AS position, ds, orders, round(gmv, 2) AS gmv FROM (SELECT * FROM demand ORDER BY ds DESC LIMIT 7)"),
)
def demand_last_window(c):
    return rounded(FE.last_window(FE.daily_demand(c.order_lines()).select("ds", "orders", "gmv"), 7), gmv=2)


@query(
    "demand_scaled",
    sql(
        "demand",
        "SELECT ds, round((orders - avg(orders) OVER ()) / stddev_pop(orders) OVER () + 1e-9, 6) + 0.0 AS orders_z, "
        "round((gmv - avg(gmv) OVER ()) / stddev_pop(gmv) OVER () + 1e-9, 6) + 0.0 AS gmv_z FROM demand",
    ),
)
def demand_scaled(c):
    out = FE.scaled(FE.daily_demand(c.order_lines()).select("ds", "orders", "gmv"), ["orders", "gmv"])
    return rounded(out.select("ds", "orders_z", "gmv_z"), orders_z=6, gmv_z=6)
