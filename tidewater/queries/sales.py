"""Sales marts and dashboards."""

from pyspark.sql import functions as F

from tidewater.plans import dashboards as D
from tidewater.plans import features as FE
from tidewater.plans import marts as M
from tidewater.plans.star import session_values
from tidewater.operators.sessions import last_items, session_facts
from tidewater.plans.schemas import STOCK_ALERT
from tidewater.queries.oracle import sessions_sql, sql
from tidewater.queries.registry import as_of, joined, query, rounded


@query(
    "product_metrics_daily",
    sql(
        "pmd products",
        "SELECT order_date, product_id, orders, units_sold, round(gmv, 2) AS gmv, title, category, seller_id "
        "FROM pmd LEFT JOIN products USING (product_id)",
    ),
)
def product_metrics_daily(c):
    return rounded(M.product_metrics_daily(c.order_lines(), c.products()), gmv=2)


@query(
    "seller_metrics_daily",
    sql(
        "sold products",
        "SELECT CAST(created_at AS DATE) AS order_date, seller_id, count(*) AS orders, sum(quantity) AS units_sold, "
        "round(sum(total_amount), 2) AS gmv FROM sold LEFT JOIN products USING (product_id) GROUP BY ALL",
    ),
)
def seller_metrics_daily(c):
    return rounded(M.seller_metrics_daily(c.order_lines(), c.products()), gmv=2)


_GMV = (
    "SELECT CAST(created_at AS DATE) AS order_date, round(sum(total_amount), 2) AS gmv, count(*) AS orders, "
    "round(avg(total_amount) + 1e-9, 6) AS aov FROM live {} GROUP BY ALL"
)


@query("gmv_by_day", sql("live", _GMV.format("")))
def gmv_by_day(c):
    return rounded(D.gmv_by_day(c.order_lines()), gmv=2, aov=6)


@query("gmv_last_30d", sql("cutoff live", _GMV.format("WHERE CAST(created_at AS DATE) >= (SELECT d FROM cutoff) - 30")))
def gmv_last_30d(c):
    lines = c.order_lines()
    return rounded(D.gmv_by_day(lines, 30, as_of(c.orders())), gmv=2, aov=6)


@query(
    "gmv_half_over_half",
    sql(
        "live",
        "SELECT round(sum(gmv), 2) AS gmv_total, CAST(sum(orders) AS BIGINT) AS orders_total, round(avg(aov) + 1e-9, 6) AS aov_avg, "
        "round(sum(gmv) FILTER (pos <= h), 2) AS prev_gmv, round(sum(gmv) FILTER (pos > h), 2) AS curr_gmv, "
        "round((sum(gmv) FILTER (pos > h) - sum(gmv) FILTER (pos <= h)) / greatest(sum(gmv) FILTER (pos <= h), 1.0) * 100 + 1e-9, 6) AS delta_pct "
        "FROM (SELECT *, row_number() OVER (ORDER BY order_date) AS pos, greatest(count(*) OVER () // 2, 1) AS h FROM daily)",
        "daily AS (SELECT CAST(created_at AS DATE) AS order_date, sum(total_amount) AS gmv, count(*) AS orders, "
        "avg(total_amount) AS aov FROM live GROUP BY ALL)",
    ),
)
def gmv_half_over_half(c):
    totals = D.gmv_half_over_half(D.gmv_by_day(c.order_lines()))
    return rounded(totals, gmv_total=2, aov_avg=6, prev_gmv=2, curr_gmv=2, delta_pct=6)


@query("status_mix", sql("lines", "SELECT status, count(*) AS orders FROM lines GROUP BY status"))
def status_mix(c):
    return D.status_mix(c.order_lines())


@query(
    "category_sales",
    sql(
        "pmd products",
        "SELECT coalesce(category, 'unknown') AS category, round(sum(gmv), 2) AS gmv, CAST(sum(orders) AS BIGINT) AS orders, "
        "sum(units_sold) AS units_sold FROM pmd LEFT JOIN products USING (product_id) GROUP BY ALL",
    ),
)
def category_sales(c):
    daily = M.product_metrics_daily(c.order_lines(), c.products())
    return rounded(D.category_sales(daily, c.products()), gmv=2)


@query(
    "top_products",
    sql(
        "pmd products",
        "SELECT product_id, coalesce(any_value(title), CAST(product_id AS VARCHAR)) AS product_name, "
        "coalesce(any_value(category), 'unknown') AS category, any_value(price) AS price, any_value(stock) AS stock, "
        "round(coalesce(sum(gmv), 0), 2) AS gmv, CAST(coalesce(sum(orders), 0) AS BIGINT) AS orders, "
        "coalesce(sum(units_sold), 0) AS units_sold FROM products LEFT JOIN pmd USING (product_id) "
        "GROUP BY product_id ORDER BY gmv DESC NULLS LAST, product_id LIMIT 25",
    ),
)
def top_products(c):
    daily = M.product_metrics_daily(c.order_lines(), c.products())
    return rounded(D.top_products(c.products(), daily), gmv=2)


@query(
    "lowest_stock",
    sql("products", "SELECT product_id, title, stock FROM products ORDER BY stock ASC NULLS FIRST, product_id LIMIT 15"),
)
def lowest_stock(c):
    return D.lowest_stock(c.products())


def alert_rows(c):
    """Stock alerts as raw domain events: every shipped line of 45 or more units reports what is left of 50."""
    lines = c.table("lineitem").where("l_quantity >= 45")
    body = F.to_json(
        F.struct(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            (50 - F.col("l_quantity")).cast("int").alias("stock"),
            F.lit(6).alias("threshold"),
        )
    )
    return lines.select(
        body.alias("payload_json"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
        F.to_date("l_shipdate").alias("event_date"),
    )


@query(
    "stock_alerts",
    "SELECT l_partkey AS product_id, l_suppkey AS seller_id, CAST(NULL AS VARCHAR) AS title, CAST(50 - l_quantity AS INTEGER) AS stock, "
    "6 AS threshold, l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS event_date FROM lineitem WHERE l_quantity >= 45",
)
def stock_alerts(c):
    return M.stock_alerts(alert_rows(c), STOCK_ALERT)


@query(
    "stock_alerts_by_day",
    "SELECT CAST(l_shipdate AS DATE) AS alert_date, count(*) AS alerts FROM lineitem WHERE l_quantity >= 45 GROUP BY ALL",
)
def stock_alerts_by_day(c):
    return D.stock_alerts_by_day(M.stock_alerts(alert_rows(c), STOCK_ALERT))


@query(
    "latest_orders",
    sql("heads", "SELECT order_id, user_id, status, total_amount, created_at FROM heads ORDER BY created_at DESC, order_id DESC LIMIT 10"),
)
def latest_orders(c):
    return D.latest_orders(c.orders().select("order_id", "user_id", "status", "total_amount", "created_at"))


@query(
    "table_counts",
    sql(
        "lines pays ev pmd rfmraw",
        "SELECT 'order_lines' AS table_name, count(*) AS rows FROM lines UNION ALL SELECT 'payments', count(*) FROM pays "
        "UNION ALL SELECT 'events', count(*) FROM ev UNION ALL SELECT 'product_metrics_daily', count(*) FROM pmd "
        "UNION ALL SELECT 'customer_rfm', count(*) FROM rfmraw",
    ),
)
def table_counts(c):
    lines = c.order_lines()
    return D.table_counts(
        {
            "order_lines": lines,
            "payments": c.payments(),
            "events": c.events(),
            "product_metrics_daily": M.product_metrics_daily(lines, c.products()),
            "customer_rfm": M.customer_rfm_raw(lines, as_of(c.orders())),
        }
    )


@query(
    "training_sequences",
    sql(
        "ev",
        "SELECT session_sk, user_id, list_aggregate(l[-50:], 'string_agg', ',') AS items FROM (SELECT md5(user_id || '-' || session_num) AS session_sk, user_id, "
        "list(CAST(product_id AS VARCHAR) ORDER BY event_ts, event_id) AS l, count(*) AS n "
        "FROM numbered WHERE product_id IS NOT NULL GROUP BY user_id, session_num) WHERE n >= 2",
        sessions_sql(720),
    ),
)
def training_sequences(c):
    sequences = last_items(c.events(), 720, max_items=50, min_length=2)
    return sequences.select("session_sk", "user_id", joined("items").alias("items"))


@query(
    "sales_heatmap",
    sql(
        "pays",
        "SELECT dayofweek(created_at) + 1 AS dow, hour(created_at) AS hour, count(*) AS orders, round(sum(amount), 2) AS gmv "
        "FROM pays GROUP BY ALL",
    ),
    ints="dow hour",
)
def sales_heatmap(c):
    return rounded(D.sales_heatmap(c.payments()), gmv=2)


@query(
    "business_metrics",
    sql(
        "ev heads",
        "SELECT round(sum(total_amount), 2) AS gmv, count(*) AS orders, round(sum(total_amount) / count(*) + 1e-9, 6) AS aov, "
        "round(sum(total_amount) / count(DISTINCT user_id) + 1e-9, 6) AS avg_ltv, "
        "(SELECT round(avg(CASE WHEN converted THEN 1.0 ELSE 0.0 END) + 1e-9, 6) FROM sess) AS conversion_rate "
        "FROM heads WHERE status NOT IN ('pending', 'refunded')",
        sessions_sql(720),
    ),
)
def business_metrics(c):
    sessions = session_facts(c.events(), 720, with_sequence=False)
    out = M.business_metrics(c.orders(), sessions, excluded=("pending", "refunded"))
    return rounded(out, gmv=2, aov=6, avg_ltv=6, conversion_rate=6)


@query(
    "product_funnel_daily",
    sql("funnel", "SELECT event_date, product_id, impressions, unique_users, orders, round(revenue, 2) AS revenue, round(conversion_rate + 1e-9, 6) AS conversion_rate FROM funnel"),
)
def product_funnel_daily(c):
    events = c.events()
    bought = events.where("event_type = 'purchase'").select(
        "event_date", "product_id", F.col("event_id").alias("order_id"), F.col("value").alias("amount")
    )
    return rounded(M.product_funnel_daily(events, bought), revenue=2, conversion_rate=6)


def january(c):
    """Completed orders moved into the month of the events, user ids folded onto the event users."""
    day = F.datediff(F.to_date("created_at"), F.lit("1995-01-01").cast("date")) % 30
    return c.orders().select(
        "order_id",
        (F.col("user_id") % 150).alias("user_id"),
        "total_amount",
        (F.col("status") == "completed").alias("is_completed"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).cast("timestamp").alias("created_at"),
    )


_JANUARY = (
    "jan AS (SELECT order_id, user_id % 150 AS user_id, total_amount, "
    "DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(created_at AS DATE)) % 30 AS INTEGER) AS d FROM done)"
)


@query(
    "purchase_fanout_daily",
    sql(
        "ev done",
        "SELECT event_date, product_id, impressions, unique_users, coalesce(orders, 0) AS orders, "
        "round(coalesce(revenue, 0), 2) AS revenue, round(coalesce(orders, 0) * 1.0 / impressions + 1e-9, 6) AS conversion_rate "
        "FROM (SELECT event_date, product_id, count(*) AS impressions, count(DISTINCT user_id) AS unique_users FROM ev "
        "WHERE event_type = 'clicks' AND product_id IS NOT NULL GROUP BY ALL) LEFT JOIN "
        "(SELECT jan.d AS event_date, p.product_id, count(DISTINCT order_id) AS orders, sum(total_amount) AS revenue "
        "FROM jan JOIN ev p ON p.event_type = 'purchase' AND p.user_id = jan.user_id WHERE p.product_id IS NOT NULL GROUP BY ALL) "
        "USING (event_date, product_id)",
        _JANUARY,
    ),
)
def purchase_fanout_daily(c):
    return rounded(M.purchase_fanout_daily(c.events(), january(c)), revenue=2, conversion_rate=6)


@query(
    "session_values",
    sql(
        "ev done",
        "SELECT s.session_sk, s.user_id, round(coalesce(sum(o.total_amount), 0), 2) AS total_value FROM sess s "
        "LEFT JOIN placed o ON o.user_id = s.user_id AND o.at BETWEEN s.session_start AND s.session_end GROUP BY ALL",
        sessions_sql(720) + ", " + _JANUARY + ", placed AS (SELECT user_id, total_amount, "
        "CAST(d AS TIMESTAMP) + to_seconds(order_id * 7919 % 86400) AS at FROM jan)",
    ),
)
def session_value_totals(c):
    sessions = session_facts(c.events(), 720, with_sequence=False)
    seconds = F.make_dt_interval(secs=(F.col("order_id") * 7919 % 86400).cast("decimal(18,6)"))
    placed = january(c).where("is_completed").withColumn("created_at", F.col("created_at") + seconds)
    return rounded(session_values(sessions, placed).select("session_sk", "user_id", "total_value"), total_value=2)


@query(
    "daily_demand",
    sql("demand", "SELECT ds, orders, round(gmv, 2) AS gmv, buyers, units FROM demand"),
)
def daily_demand(c):
    return rounded(FE.daily_demand(c.order_lines()), gmv=2)


@query(
    "category_demand_daily",
    sql(
        "live products",
        "SELECT category, ds, coalesce(orders, 0) AS orders, round(coalesce(gmv, 0), 2) AS gmv, coalesce(units, 0) AS units "
        "FROM (SELECT DISTINCT category FROM tot) CROSS JOIN "
        "(SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM tot) LEFT JOIN tot USING (category, ds)",
        "tot AS (SELECT category, CAST(created_at AS DATE) AS ds, count(*) AS orders, sum(total_amount) AS gmv, sum(quantity) AS units "
        "FROM live JOIN products USING (product_id) GROUP BY ALL)",
    ),
)
def category_demand_daily(c):
    return rounded(FE.category_demand_daily(c.order_lines(), c.products()), gmv=2)
