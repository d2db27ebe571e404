"""Data quality."""

from pyspark.sql import functions as F

from tidewater.operators import quality as Q
from tidewater.plans import star as S
from tidewater.queries.oracle import sql
from tidewater.queries.registry import query, rounded

SUITE = (
    Q.exists("order_sk"),
    Q.exists("ship_mode"),
    Q.not_null("order_id"),
    Q.not_null("completed_at"),
    Q.unique("order_id"),
    Q.unique("user_id"),
    Q.in_set("status", ("pending", "completed")),
    Q.between("total_amount", low=10_000, strict_low=True),
    Q.between("items_count", low=2, high=7),
    Q.regex("order_date_sk", r"^(199[5-9]|2000)\d{4}$"),
    Q.row_count(low=1),
    Q.row_count(high=10),
)

_SUITE_SQL = """SELECT rule, failing = 0 AS passed, failing, total FROM (
    SELECT unnest([
        {'rule': 'exists(order_sk)', 'failing': 0}, {'rule': 'exists(ship_mode)', 'failing': 1}, {'rule': 'not_null(order_id)', 'failing': 0},
        {'rule': 'not_null(completed_at)', 'failing': count(*) FILTER (completed_at IS NULL)},
        {'rule': 'unique(order_id)', 'failing': (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM heads GROUP BY order_id) WHERE n > 1)},
        {'rule': 'unique(user_id)', 'failing': (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM heads GROUP BY user_id) WHERE n > 1)},
        {'rule': 'in_set(status)', 'failing': count(*) FILTER (status NOT IN ('pending', 'completed'))},
        {'rule': 'between(total_amount)', 'failing': count(*) FILTER (total_amount <= 10000)},
        {'rule': 'between(items_count)', 'failing': count(*) FILTER (items_count < 2 OR items_count > 7)},
        {'rule': 'regex(order_date_sk)', 'failing': count(*) FILTER (year(created_at) > 2000)},
        {'rule': 'row_count', 'failing': 0}, {'rule': 'row_count', 'failing': CASE WHEN count(*) > 10 THEN 1 ELSE 0 END}
    ], recursive := true), count(*) AS total FROM heads)"""


def gold_orders(c):
    users = S.dim_users(c.users())
    return S.fact_orders(c.orders(), users, S.dim_date(c.spark, "1995-01-01", "2003-01-01"))


@query("dq_suite", sql("heads", _SUITE_SQL))
def dq_suite(c):
    return Q.run_suite(gold_orders(c), SUITE)


@query(
    "dq_success_rate",
    sql(
        "heads",
        "SELECT CAST(6 AS BIGINT) AS rules, 2 + CAST(a AS BIGINT) + CAST(b AS BIGINT) + CAST(d AS BIGINT) + CAST(e AS BIGINT) AS passed, "
        "round((2 + CAST(a AS BIGINT) + CAST(b AS BIGINT) + CAST(d AS BIGINT) + CAST(e AS BIGINT)) / 6 + 1e-9, 6) AS success_rate FROM "
        "(SELECT count(*) FILTER (status IS NULL) = 0 AS a, count(*) FILTER (total_amount <= 10000) = 0 AS b, "
        "count(*) FILTER (completed_at IS NULL) = 0 AS d, count(*) FILTER (status NOT IN ('pending', 'completed', 'processing')) = 0 AS e FROM heads)",
    ),
)
def dq_success_rate(c):
    rules = (
        Q.exists("order_id"),
        Q.row_count(low=1),
        Q.not_null("status"),
        Q.between("total_amount", low=10_000, strict_low=True),
        Q.not_null("completed_at"),
        Q.in_set("status", ("pending", "completed", "processing")),
    )
    return rounded(Q.success_rate(Q.run_suite(c.orders(), rules)), success_rate=6)


@query(
    "dq_unique",
    """SELECT rule, failing = 0 AS passed, failing, total FROM (
    SELECT 'unique(l_orderkey)' AS rule, CAST(sum(n) FILTER (n > 1) AS BIGINT) AS failing, CAST(sum(n) AS BIGINT) AS total
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
    UNION ALL SELECT 'unique(version)', CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT), CAST(sum(n) AS BIGINT)
    FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY o_orderkey))""",
)
def dq_unique(c):
    """A repeating key, and a key that repeats only outside the condition."""
    lines = Q.run_suite(c.table("lineitem").select("l_orderkey"), [Q.unique("l_orderkey")])
    orders = c.table("orders").select(F.col("o_orderkey").alias("version"), (F.col("o_orderkey") % 2 == 0).alias("is_current"))
    twice = orders.unionByName(orders.withColumn("is_current", F.lit(False)))
    return lines.unionByName(Q.run_suite(twice, [Q.unique("version", where="is_current = true")]))


@query(
    "dq_relationships",
    "SELECT l_partkey, count(*) AS orphans FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY 1",
)
def dq_relationships(c):
    parts = c.table("part").where("p_size > 5")
    missing = Q.orphans(c.table("lineitem").select("l_partkey"), parts, "l_partkey", "p_partkey")
    return missing.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("orphans"))


@query(
    "dq_null_rates",
    sql(
        "users",
        "SELECT column_name, nulls, rows, round(nulls / rows + 1e-9, 6) AS null_rate FROM (SELECT unnest([{'column_name': 'gender', 'nulls': count(*) FILTER (gender IS NULL)}, "
        "{'column_name': 'status', 'nulls': count(*) FILTER (status IS NULL)}, {'column_name': 'email', 'nulls': 0}], recursive := true), count(*) AS rows FROM users)",
    ),
)
def dq_null_rates(c):
    return rounded(Q.null_rates(c.users(), ["gender", "status", "email"]), null_rate=6)


@query(
    "dq_schema_drift",
    "SELECT 'k' AS field, count(*) AS rows, 'added' AS change FROM events UNION ALL SELECT 'm', count(*), 'declared' FROM events WHERE event_id % 4 = 0 "
    "UNION ALL SELECT 'z', 0, 'missing'",
)
def dq_schema_drift(c):
    """Keys of the event payloads against a declaration that knows m and z."""
    payload = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"m": 1, '), F.substring_index("props", "{", -1))).otherwise(F.col("props"))
    return Q.payload_drift(c.table("events").select(payload.alias("payload")), "payload", ["m", "z"])


@query(
    "dq_quarantine",
    sql(
        "heads",
        "SELECT order_id, concat_ws(',', CASE WHEN completed_at IS NULL THEN 'not_null(completed_at)' END, "
        "CASE WHEN total_amount < 20000 THEN 'between(total_amount)' END) AS failed_rules FROM heads WHERE completed_at IS NULL OR total_amount < 20000",
    ),
)
def dq_quarantine(c):
    _, rejected = Q.quarantine(c.orders(), [Q.not_null("completed_at"), Q.between("total_amount", low=20_000)])
    return rejected.select("order_id", F.array_join("failed_rules", ",").alias("failed_rules"))
