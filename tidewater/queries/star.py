"""Calendar, dimensions, facts, sessions."""

from pyspark.sql import functions as F

from tidewater.operators.sessions import session_facts
from tidewater.plans import star as S
from tidewater.queries.oracle import sessions_sql, sql
from tidewater.queries.registry import joined, query

_HOLIDAYS = (
    "h(hd, hm, holiday_name) AS (VALUES (1, 1, 'Confraternização Universal'), (21, 4, 'Tiradentes'), (1, 5, 'Dia do Trabalho'), "
    "(7, 9, 'Independência'), (12, 10, 'N. Sra. Aparecida'), (2, 11, 'Finados'), (15, 11, 'Proclamação da República'), (25, 12, 'Natal'))"
)


@query(
    "dim_date",
    f"""WITH {_HOLIDAYS}, perday AS (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS orders FROM orders GROUP BY 1),
    days AS (SELECT CAST(unnest(generate_series(min(full_date), max(full_date), INTERVAL 1 DAY)) AS DATE) AS full_date FROM perday)
    SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_sk, full_date, year(full_date) AS year, month(full_date) AS month_of_year,
    day(full_date) AS day_of_month, weekofyear(full_date) AS week_of_year, dayofweek(full_date) + 1 AS day_of_week,
    dayname(full_date) AS day_name, monthname(full_date) AS month_name, quarter(full_date) AS quarter,
    dayofweek(full_date) IN (0, 6) AS is_weekend,
    month(full_date) = 11 AND dayofweek(full_date) = 5 AND day(full_date) BETWEEN 23 AND 29 AS is_black_friday,
    holiday_name IS NOT NULL AS is_national_holiday, holiday_name, coalesce(orders, 0) AS orders
    FROM days LEFT JOIN h ON hd = day(full_date) AND hm = month(full_date) LEFT JOIN perday USING (full_date)""",
    ints="year month_of_year day_of_month week_of_year day_of_week quarter",
)
def dim_date(c):
    """The calendar over the span of the orders, with the orders of each day."""
    per_day = c.table("orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("orders"))
    return S.calendar(S.spine_of(per_day, "full_date")).join(per_day, "full_date", "left").fillna({"orders": 0})


@query(
    "dim_customer",
    sql(
        "users",
        "SELECT md5(CAST(user_id AS VARCHAR)) AS user_sk, user_id, name, email, user_type, CASE gender WHEN 'F' THEN 'Feminino' "
        "WHEN 'M' THEN 'Masculino' WHEN 'NB' THEN 'Não-binário' ELSE 'Não informado' END AS gender, status, created_at FROM users",
    ),
)
def dim_customer(c):
    return S.dim_users(c.users())


@query(
    "dim_product",
    sql(
        "products",
        "SELECT md5(CAST(product_id AS VARCHAR)) AS product_sk, *, CASE WHEN stock > 0 THEN 'in_stock' ELSE 'out_of_stock' END AS stock_status FROM products",
    ),
)
def dim_product(c):
    return S.dim_products(c.products())


@query(
    "fact_orders",
    sql(
        "heads users",
        "SELECT md5(CAST(order_id AS VARCHAR)) AS order_sk, order_id, CASE WHEN u.user_id IS NULL THEN 'unknown' ELSE md5(CAST(u.user_id AS VARCHAR)) END AS user_sk, "
        "h.user_id, CAST(strftime(h.created_at, '%Y%m%d') AS INTEGER) AS order_date_sk, h.status, total_amount, currency, payment_method, items_count, "
        "h.created_at, completed_at, h.status = 'completed' AS is_completed, "
        "date_diff('day', CAST(h.created_at AS DATE), CAST(completed_at AS DATE)) AS fulfillment_days "
        "FROM heads h LEFT JOIN (SELECT user_id FROM users WHERE user_type = 'BUYER') u ON u.user_id = h.user_id",
    ),
    ints="fulfillment_days",
)
def fact_orders(c):
    """Sellers are left out of the dimension, and the calendar starts in 1998, so both fallbacks take part."""
    users = S.dim_users(c.users().where("user_type = 'BUYER'"))
    return S.fact_orders(c.orders(), users, S.dim_date(c.spark, "1998-01-01", "2003-01-01"))


@query(
    "fact_events",
    sql(
        "ev users products",
        "SELECT event_id, event_type, session_id, CASE WHEN u.user_id IS NULL THEN 'unknown' ELSE md5(CAST(u.user_id AS VARCHAR)) END AS user_sk, "
        "ev.user_id, CASE WHEN p.product_id IS NULL THEN 'unknown' ELSE md5(CAST(p.product_id AS VARCHAR)) END AS product_sk, ev.product_id, "
        "CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS event_date_sk, event_ts, event_date, payload FROM ev "
        "LEFT JOIN (SELECT user_id FROM users WHERE user_type = 'BUYER') u ON u.user_id = ev.user_id "
        "LEFT JOIN (SELECT product_id FROM products WHERE stock IS NOT NULL) p ON p.product_id = ev.product_id",
    ),
)
def fact_events(c):
    users = S.dim_users(c.users().where("user_type = 'BUYER'"))
    products = S.dim_products(c.products().where("stock is not null"))
    return S.fact_events(c.events(), users, products, S.dim_date(c.spark))


_SESSION = (
    "SELECT session_sk, session_id, user_id, session_num, session_start, session_end, duration_seconds, event_count, "
    "distinct_products_viewed, purchases, cart_actions, converted{} FROM sess"
)


@query("fact_sessions", sql("ev", _SESSION.format(", product_sequence"), sessions_sql(30)))
def fact_sessions(c):
    return S.fact_sessions(c.events()).withColumn("product_sequence", joined("product_sequence"))


@query("fact_sessions_12h", sql("ev", _SESSION.format(", product_sequence"), sessions_sql(720)))
def fact_sessions_12h(c):
    return S.fact_sessions(c.events(), 720).withColumn("product_sequence", joined("product_sequence"))


@query("session_totals", sql("ev", _SESSION.format(""), sessions_sql(720)))
def session_totals(c):
    """Sessions without arrays: partial aggregates all the way."""
    return session_facts(c.events(), 720, with_sequence=False)
