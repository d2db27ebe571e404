"""Named parts of the oracle SQL: the commerce tables in DuckDB's words."""

from __future__ import annotations

_PARTS = {
    "cutoff": "cutoff AS (SELECT CAST(max(o_orderdate) AS DATE) + 1 AS d FROM orders)",
    "users": """users AS (
        SELECT c_custkey AS user_id, ' ' || c_name || ' ' AS name,
               'USER' || c_custkey || '@Shop.example ' AS email,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SELLER' ELSE 'BUYER' END AS user_type,
               CASE c_custkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'NB' END AS gender,
               CASE WHEN c_custkey % 5 <> 0 THEN 'active' END AS status,
               CAST(DATE '1995-01-01' - CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at
        FROM customer)""",
    "products": """products AS (
        SELECT p_partkey AS product_id, p_name AS title, p_type AS category, p_brand AS brand,
               p_retailprice AS price, CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS stock,
               p_partkey % 100 AS seller_id
        FROM part)""",
    "lines": """lines AS (
        SELECT o_orderkey AS order_id, o_custkey AS buyer_id, l_partkey AS product_id,
               l_quantity AS quantity, l_extendedprice AS total_amount,
               CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' WHEN o_orderstatus = 'F' THEN 'DELIVERED'
                    WHEN o_orderstatus = 'P' THEN 'PAID' WHEN l_linestatus = 'O' THEN 'CREATED' ELSE 'SHIPPED' END AS status,
               o_orderdate AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "sold": "sold AS (SELECT * FROM lines WHERE status IN ('CREATED','CONFIRMED','SHIPPED','DELIVERED'))",
    "live": "live AS (SELECT * FROM lines WHERE status IN ('CREATED','PAID','CONFIRMED','SHIPPED','DELIVERED'))",
    "heads": """heads AS (
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' ELSE 'processing' END AS status,
               o_totalprice AS total_amount, 'BRL' AS currency,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'pix' WHEN '3-MEDIUM' THEN 'boleto'
                    WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'wallet' END AS payment_method,
               CAST(o_orderkey % 7 + 1 AS INTEGER) AS items_count, o_orderdate AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 15 AS INTEGER)) END AS completed_at
        FROM orders)""",
    "done": "done AS (SELECT * FROM heads WHERE status = 'completed')",
    "pays": """pays AS (
        SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS order_id,
               CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS buyer_id, o_totalprice AS amount,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'pix' WHEN '3-MEDIUM' THEN 'boleto'
                    WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'wallet' END AS method,
               CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'P' THEN 'FAILED' ELSE 'PENDING' END AS status,
               o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS created_at
        FROM orders)""",
    "ev": """ev AS (
        SELECT event_id, user_id,
               CASE WHEN event_type = 'view' THEN 'w' || user_id || '-' || day(ts) END AS session_id,
               CASE WHEN event_type IN ('click','view','purchase') THEN CAST(props->>'$.k' AS BIGINT) END AS product_id,
               CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'cart' WHEN 'signup' THEN 'search' ELSE event_type END AS event_type,
               props AS payload, ts AS event_ts, CAST(ts AS DATE) AS event_date, value
        FROM events)""",
    "pmd": """pmd AS (
        SELECT CAST(created_at AS DATE) AS order_date, product_id, count(*) AS orders,
               sum(quantity) AS units_sold, sum(total_amount) AS gmv
        FROM sold GROUP BY ALL)""",
    "rfmraw": """rfmraw AS (
        SELECT buyer_id, max(created_at) AS last_order_at, count(*) AS frequency, sum(total_amount) AS monetary,
               date_diff('day', CAST(max(created_at) AS DATE), (SELECT d FROM cutoff)) * 1.0 AS recency_days
        FROM sold GROUP BY buyer_id)""",
    "rfmdash": """rfmdash AS (
        SELECT *, CASE WHEN r_score = 5 AND f_score >= 4 THEN 'Champions' WHEN r_score >= 4 AND f_score >= 3 THEN 'Loyal'
                       WHEN r_score >= 3 AND m_score >= 4 THEN 'Big Spenders' WHEN r_score = 5 AND f_score <= 2 THEN 'New Customers'
                       WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating'
                       ELSE 'Need Attention' END AS rfm_segment
        FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, buyer_id) AS r_score,
                     ntile(5) OVER (ORDER BY frequency, buyer_id) AS f_score,
                     ntile(5) OVER (ORDER BY round(monetary, 2), buyer_id) AS m_score FROM rfmraw))""",
    "rfmmart": """rfmmart AS (
        SELECT *, r_score + f_score + m_score AS rfm_total, concat(r_score, f_score, m_score) AS rfm_cell,
               CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                    WHEN r_score >= 4 AND f_score < 2 THEN 'Recent Customers' WHEN r_score < 2 AND f_score >= 3 THEN 'At Risk'
                    WHEN r_score < 2 AND f_score < 2 THEN 'Lost' ELSE 'Potential Loyalists' END AS rfm_segment
        FROM (SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, user_id) AS INTEGER) AS r_score,
                     CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS f_score,
                     CAST(ntile(5) OVER (ORDER BY round(monetary, 2), user_id) AS INTEGER) AS m_score
              FROM (SELECT user_id, date_diff('day', CAST(max(created_at) AS DATE), (SELECT d FROM cutoff)) AS recency_days,
                           count(*) AS frequency, sum(total_amount) AS monetary FROM done GROUP BY user_id)))""",
    "churn": """churn AS (
        SELECT *, date_diff('day', last_order_date, (SELECT d FROM cutoff)) AS days_since_last_order,
               date_diff('day', first_order_date, last_order_date) AS customer_tenure_days,
               orders_last_30d * 1.0 / total_orders AS recency_ratio,
               CASE WHEN date_diff('day', last_order_date, (SELECT d FROM cutoff)) > 60 THEN 1 ELSE 0 END AS churn_label
        FROM (SELECT user_id, count(*) AS total_orders, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_order_value,
                     CAST(min(created_at) AS DATE) AS first_order_date, CAST(max(created_at) AS DATE) AS last_order_date,
                     count(*) FILTER (CAST(created_at AS DATE) >= (SELECT d FROM cutoff) - 30) AS orders_last_30d,
                     count(*) FILTER (CAST(created_at AS DATE) >= (SELECT d FROM cutoff) - 90) AS orders_last_90d,
                     avg(items_count) AS avg_items_per_order
              FROM done GROUP BY user_id))""",
    "demand": """demand AS (
        SELECT CAST(created_at AS DATE) AS ds, count(*) AS orders, sum(total_amount) AS gmv,
               count(DISTINCT buyer_id) AS buyers, sum(quantity) AS units
        FROM live GROUP BY ALL)""",
    "matrix": """matrix AS (
        SELECT buyer_id, product_id, sum(quantity) AS units, count(*) AS orders, sum(total_amount) AS gmv
        FROM live GROUP BY ALL)""",
    "ufeat": """ufeat AS (
        SELECT o.*, coalesce(p.payments_total, 0) AS payments_total, coalesce(p.payment_fail_rate, 0.0) AS payment_fail_rate,
               coalesce(p.avg_payment_amount, 0.0) AS avg_payment_amount, u.name, u.email, u.user_type, u.created_at AS user_created_at,
               date_diff('second', o.last_order_at, CAST((SELECT d FROM cutoff) AS TIMESTAMP)) / 86400.0 AS recency_days,
               date_diff('second', o.first_order_at, CAST((SELECT d FROM cutoff) AS TIMESTAMP)) / 86400.0 AS tenure_days,
               o.orders_total / (date_diff('second', o.first_order_at, CAST((SELECT d FROM cutoff) AS TIMESTAMP)) / 86400.0 / 7.0) AS frequency_per_week
        FROM (SELECT buyer_id, count(*) AS orders_total, sum(total_amount) AS monetary, avg(total_amount) AS avg_order_value,
                     max(created_at) AS last_order_at, min(created_at) AS first_order_at, count(DISTINCT product_id) AS distinct_products
              FROM live GROUP BY buyer_id) o
        LEFT JOIN (SELECT buyer_id, count(*) AS payments_total,
                          sum(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END) / count(*) AS payment_fail_rate,
                          avg(amount) AS avg_payment_amount FROM pays GROUP BY buyer_id) p USING (buyer_id)
        LEFT JOIN users u ON u.user_id = o.buyer_id)""",
    "paydata": """paydata AS (
        SELECT payment_id, buyer_id, amount, method, status, created_at, hour(created_at) AS hour, dayofweek(created_at) + 1 AS dow,
               coalesce(n, 0) AS buyer_pay_count, coalesce(m, 0.0) AS buyer_avg_amount, coalesce(f, 0.0) AS buyer_fail_rate_hist,
               CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS failed_label
        FROM pays LEFT JOIN (SELECT buyer_id, count(*) AS n, avg(amount) AS m,
                                    sum(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END) / count(*) AS f
                             FROM pays GROUP BY buyer_id) USING (buyer_id))""",
    "funnel": """funnel AS (
        SELECT event_date, product_id, impressions, unique_users, coalesce(orders, 0) AS orders, coalesce(revenue, 0.0) AS revenue,
               coalesce(orders, 0) * 1.0 / impressions AS conversion_rate
        FROM (SELECT event_date, product_id, count(*) AS impressions, count(DISTINCT user_id) AS unique_users
              FROM ev WHERE event_type = 'clicks' AND product_id IS NOT NULL GROUP BY ALL) c
        LEFT JOIN (SELECT event_date, product_id, count(DISTINCT event_id) AS orders, sum(value) AS revenue
                   FROM ev WHERE event_type = 'purchase' AND product_id IS NOT NULL GROUP BY ALL) p USING (event_date, product_id))""",
}

_NEEDS = {
    "sold": ("lines",),
    "live": ("lines",),
    "done": ("heads",),
    "pmd": ("sold",),
    "rfmraw": ("cutoff", "sold"),
    "rfmdash": ("rfmraw",),
    "rfmmart": ("cutoff", "done"),
    "churn": ("cutoff", "done"),
    "demand": ("live",),
    "matrix": ("live",),
    "ufeat": ("cutoff", "live", "pays", "users"),
    "paydata": ("pays",),
    "funnel": ("ev",),
}


def sessions_sql(gap: int) -> str:
    """Sessions by the definition: previous event, gap flag, running sum."""
    return f"""flagged AS (
        SELECT *, CASE WHEN prev IS NULL OR date_sub('minute', prev, event_ts) > {gap} THEN 1 ELSE 0 END AS starts
        FROM (SELECT *, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, event_id) AS prev FROM ev)),
    numbered AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY event_ts) AS BIGINT) AS session_num FROM flagged),
    sess AS (
        SELECT md5(user_id || '-' || session_num) AS session_sk,
               coalesce(min(session_id), user_id || '_' || session_num) AS session_id, user_id, session_num,
               min(event_ts) AS session_start, max(event_ts) AS session_end,
               date_sub('second', min(event_ts), max(event_ts)) AS duration_seconds, count(*) AS event_count,
               count(DISTINCT product_id) AS distinct_products_viewed,
               count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'cart') AS cart_actions,
               count(*) FILTER (event_type = 'purchase') > 0 AS converted,
               string_agg(coalesce(CAST(product_id AS VARCHAR), 'null'), ',' ORDER BY event_ts, event_id) AS product_sequence
        FROM numbered GROUP BY user_id, session_num)"""


def sql(parts: str, body: str, extra: str = "") -> str:
    """``body`` with the named parts, and what they need, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        add(name)
    ctes = [_PARTS[name] for name in ordered] + ([extra] if extra else [])
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body
