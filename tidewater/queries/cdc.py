"""Change data, cleaning, merges, scans and landing files."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import parse_ts
from tidewater.operators import cdc as C
from tidewater.operators import cleaning as CL
from tidewater.operators import keyed as KD
from tidewater.operators import merge as MG
from tidewater.operators import versions as VS
from tidewater.plans import operational as OP
from tidewater.plans import silver as SI
from tidewater.plans.schemas import CLICK
from tidewater.queries.oracle import sql
from tidewater.queries.registry import query
from tidewater.session import work_dir
from tidewater.sources.bronze import read_bronze
from tidewater.sources.landing import FILE, coerce, file_verdicts, read_landing_csv, CATALOG
from tidewater.sources.pages import page_records
from tidewater.streaming.bronze import parse_event

ORDER_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("buyer_id", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# The change rows again, from their definition: one row per change and order.
_CHANGES = """changes AS (
    SELECT o.*, n, CASE WHEN o_orderkey % 97 = 0 AND n = 0 THEN NULL ELSE CASE n WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END END AS op,
           epoch_ms(o_orderdate) + n * 60000 AS ts_ms,
           CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' ELSE 'SHIPPED' END AS later
    FROM orders o, (VALUES (0), (1), (2)) v(n)
    WHERE n = 0 OR (n = 1 AND o_orderkey % 3 = 0) OR (n = 2 AND o_orderkey % 10 = 0))"""


def bronze(c):
    return C.parse_envelope(c.cdc_orders())


@query(
    "cdc_parse_envelope",
    f"""WITH {_CHANGES} SELECT CAST(o_orderkey AS VARCHAR) AS record_key, op AS cdc_op,
    CASE WHEN op IS NOT NULL THEN CAST(ts_ms AS VARCHAR) END AS cdc_ts_ms,
    CASE WHEN op = 'c' THEN 'CREATED' WHEN op = 'u' THEN later END AS after_status,
    CASE WHEN op = 'u' THEN 'CREATED' WHEN op = 'd' THEN CASE WHEN o_orderkey % 3 = 0 THEN later ELSE 'CREATED' END END AS before_status,
    CAST(o_orderkey % 8 AS INTEGER) AS kafka_partition, o_orderkey * 4 + n AS kafka_offset,
    o_orderdate + to_minutes(n) AS event_ts, CAST(o_orderdate AS DATE) AS event_date FROM changes""",
)
def cdc_parse_envelope(c):
    return bronze(c).select(
        "record_key",
        "cdc_op",
        "cdc_ts_ms",
        F.get_json_object("payload_after", "$.status").alias("after_status"),
        F.get_json_object("payload_before", "$.status").alias("before_status"),
        "kafka_partition",
        "kafka_offset",
        "event_ts",
        "event_date",
    )


@query(
    "cdc_parse_payload",
    f"""WITH {_CHANGES} SELECT o_orderkey AS id, o_custkey AS buyer_id, o_totalprice AS total_amount,
    CASE op WHEN 'c' THEN 'CREATED' ELSE later END AS status, o_orderdate AS created_at, op AS cdc_op FROM changes WHERE op IN ('c', 'u')""",
)
def cdc_parse_payload(c):
    return C.parse_payload(C.keep_ops(bronze(c)), ORDER_IMAGE, keep=("cdc_op",))


@query(
    "cdc_op_filter",
    f"WITH {_CHANGES} SELECT op AS cdc_op, CAST(o_orderdate AS DATE) AS event_date, count(*) AS changes FROM changes WHERE op IN ('c', 'u') GROUP BY ALL",
)
def cdc_op_filter(c):
    return C.keep_ops(bronze(c)).groupBy("cdc_op", "event_date").agg(F.count(F.lit(1)).alias("changes"))


@query(
    "cdc_op_profile",
    f"""WITH {_CHANGES} SELECT coalesce(op, 'unreadable') AS cdc_op, count(*) AS rows, count(*) FILTER (op IN ('c', 'u')) AS with_after,
    count(*) FILTER (op IN ('u', 'd')) AS with_before, min(ts_ms) FILTER (op IS NOT NULL) AS first_ts_ms,
    max(ts_ms) FILTER (op IS NOT NULL) AS last_ts_ms FROM changes GROUP BY 1""",
)
def cdc_op_profile(c):
    return C.profile(bronze(c))


_STATE = """SELECT o_orderkey AS id, o_custkey AS buyer_id, o_totalprice AS total_amount,
    CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' ELSE 'SHIPPED' END ELSE 'CREATED' END AS status,
    o_orderdate AS created_at FROM orders WHERE (o_orderkey % 3 = 0 OR o_orderkey % 97 <> 0)"""


@query("cdc_current_state", _STATE)
def cdc_current_state(c):
    return C.current_state(bronze(c), "id", ORDER_IMAGE)


@query("cdc_current_state_apply_deletes", _STATE + " AND o_orderkey % 10 <> 0")
def cdc_current_state_apply_deletes(c):
    return C.current_state(bronze(c), "id", ORDER_IMAGE, deletes="apply")


@query(
    "fact_orders_operational",
    _STATE.replace("o_orderkey AS id", "o_orderkey AS order_id").replace("o_orderdate AS created_at", "CAST(NULL AS BIGINT) AS product_id, o_orderdate AS created_at"),
)
def fact_orders_operational(c):
    return OP.fact_orders(bronze(c)).select("order_id", "buyer_id", "total_amount", "status", "product_id", "created_at")


def user_changes(c):
    """Bronze user rows: everyone created, every second one blocked later, with padded text and mixed case."""
    key = F.col("c_custkey")

    def image(status, at):
        return F.to_json(
            F.struct(
                key.cast("string").alias("user_id"),
                F.concat(F.lit(" USER"), key.cast("string"), F.lit("@X.example ")).alias("email"),
                F.concat(F.lit(" "), F.col("c_name")).alias("name"),
                status.alias("status"),
                F.lit("2024-01-01T00:00:00Z").alias("created_at"),
                F.lit(at).alias("updated_at"),
            )
        )

    first = F.struct(F.lit("c").alias("op"), image(F.when(key % 3 != 0, "active"), "2024-01-01T00:00:00Z").alias("after"))
    second = F.struct(F.lit("u").alias("op"), image(F.lit("blocked"), "1706745600000").alias("after"))
    changes = F.when(key % 2 == 0, F.array(first, second)).otherwise(F.array(first))
    return c.table("customer").select(F.explode(changes).alias("x")).select(
        F.col("x.op").alias("cdc_op"), F.col("x.after").alias("payload_after"), F.lit("0").alias("cdc_ts_ms")
    )


@query(
    "silver_users",
    """SELECT user_id, 'user' || user_id || '@x.example' AS email, c_name AS name, status, valid_from,
    CASE WHEN n = 1 AND c_custkey % 2 = 0 THEN TIMESTAMP '2024-02-01' END AS valid_to, n = 2 OR c_custkey % 2 = 1 AS is_current FROM (
    SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS user_id, c_name, 1 AS n, CASE WHEN c_custkey % 3 <> 0 THEN 'active' ELSE 'unknown' END AS status,
           TIMESTAMP '2024-01-01' AS valid_from FROM customer
    UNION ALL SELECT c_custkey, CAST(c_custkey AS VARCHAR), c_name, 2, 'blocked', TIMESTAMP '2024-02-01' FROM customer WHERE c_custkey % 2 = 0)""",
)
def silver_users(c):
    out = SI.silver_users(None, user_changes(c))
    return out.select("user_id", "email", "name", "status", "valid_from", "valid_to", "is_current")


@query(
    "silver_orders",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 3 = 0 THEN 'completed' ELSE 'pending' END AS status, "
    "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated_at FROM orders",
)
def silver_orders(c):
    """Two images of every third order, merged one batch after the other."""

    def batch(status, days):
        at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=F.lit(days))
        body = F.to_json(
            F.struct(F.col("o_orderkey").cast("string").alias("order_id"), F.lit(status).alias("status"), F.unix_millis(at).cast("string").alias("updated_at"))
        )
        return c.table("orders").select("o_orderkey", body.alias("payload_after"), F.lit("c").alias("cdc_op"), F.lit("0").alias("cdc_ts_ms"))

    first = SI.silver_orders(None, batch("pending", 0))
    return SI.silver_orders(first, batch("completed", 1).where("o_orderkey % 3 = 0")).select("order_id", "status", "updated_at")


@query(
    "cdc_dead_letters",
    "SELECT CAST(o_orderkey AS VARCHAR) AS record_key, '{bad' AS raw_json, CAST(o_orderdate AS DATE) AS event_date FROM orders WHERE o_orderkey % 97 = 0",
)
def cdc_dead_letters(c):
    return bronze(c).where(~C.is_readable(F.col("raw_json"), C.ENVELOPE)).select("record_key", "raw_json", "event_date")


@query(
    "parse_ts_mixed",
    "SELECT event_id, CASE WHEN event_id % 5 < 2 THEN ts WHEN event_id % 5 = 2 THEN date_trunc('millisecond', ts) END AS parsed FROM events",
)
def parse_ts_mixed(c):
    """Event times written as ISO text, microseconds, milliseconds, junk and null, and read back."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 1, F.unix_micros(ts).cast("string"))
        .when(kind == 2, F.unix_millis(ts).cast("string"))
        .when(kind == 3, F.lit("x"))
    )
    return c.table("events").select("event_id", parse_ts(text).alias("parsed"))


def click_messages(c):
    """Kafka-shaped click messages; every 50th is malformed, every 51st lacks its id, every 53rd has a mistyped position."""
    key = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(key % 51 != 0, key.cast("string")).alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("product_id"),
            F.when(key % 53 == 0, "first").otherwise((key % 9).cast("string")).alias("position"),
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        )
    )
    numeric = F.regexp_replace(body, r'"position":"(\d+)"', '"position":$1')
    return c.table("events").select(
        key.cast("string").cast("binary").alias("key"),
        F.when(key % 50 == 0, F.lit("{bad")).otherwise(numeric).cast("binary").alias("value"),
        F.lit("events.clicks").alias("topic"),
        (key % 4).cast("int").alias("partition"),
        key.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query(
    "event_parse",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, props->>'$.k' AS product_id, event_id % 9 AS position, "
    "ts, CAST(ts AS DATE) AS event_date, CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset FROM events "
    "WHERE event_id % 50 <> 0 AND event_id % 51 <> 0 AND event_id % 53 <> 0",
)
def event_parse(c):
    parsed = parse_event(click_messages(c), CLICK).where("event_id is not null and position is not null")
    return parsed.select("event_id", "user_id", "product_id", "position", "ts", "event_date", "kafka_partition", "kafka_offset")


@query(
    "clean_strings",
    sql("users", "SELECT user_id, lower(trim(email)) AS email, trim(name) AS name, coalesce(status, 'unknown') AS status FROM users"),
)
def clean_strings(c):
    rows = c.users().select("user_id", "email", "name", F.lit(None).cast("string").alias("phone"), "status")
    return CL.clean_users(rows).drop("phone")


@query(
    "staging_views",
    sql(
        "users heads ev",
        "SELECT 'users' AS view_name, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS key_sum FROM users WHERE user_id % 4 <> 0 "
        "UNION ALL SELECT 'orders', count(*), CAST(sum(order_id) AS BIGINT) FROM heads WHERE order_id % 5 <> 0 "
        "UNION ALL SELECT 'events', count(*), CAST(sum(event_id) AS BIGINT) FROM ev WHERE event_id % 5 <> 0 AND event_id % 7 <> 0",
    ),
)
def staging_views(c):
    """Row and key sums of the staging views; versions, keys and times are blanked out first."""
    users = c.users().withColumn("is_current", F.col("user_id") % 4 != 0)
    orders = c.orders().withColumn("order_id", F.when(F.col("order_id") % 5 != 0, F.col("order_id")))
    events = c.events().select(
        F.when(F.col("event_id") % 5 != 0, F.col("event_id")).alias("event_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_ts")).alias("ts"),
    )
    views = {
        "users": (CL.stage_current(users, "user_id"), "user_id"),
        "orders": (CL.stage_orders(orders), "order_id"),
        "events": (CL.stage_events(events), "event_id"),
    }
    out = None
    for name, (df, key) in views.items():
        line = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(key).alias("key_sum")).select(F.lit(name).alias("view_name"), "rows", "key_sum")
        out = line if out is None else out.unionByName(line)
    return out


@query(
    "events_union",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
    "CASE WHEN event_type <> 'signup' THEN props->>'$.k' END AS product_id, "
    "CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'cart' WHEN 'signup' THEN 'search' ELSE 'purchase' END AS event_type, "
    "CASE WHEN event_type = 'click' AND event_id % 10 = 0 THEN ts + INTERVAL 1 MINUTE ELSE ts END AS ts "
    "FROM events WHERE event_type IN ('click', 'view', 'signup', 'purchase')",
)
def events_union(c):
    """Four branches, one without products, and every tenth click sent twice with a later time."""
    events = c.table("events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").alias("product_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    of = lambda kind: events.where(F.col("event_type") == kind).drop("event_type")
    again = of("click").where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 minute"))
    branches = {
        "clicks": of("click").unionByName(again),
        "cart": of("view"),
        "search": of("signup").drop("product_id"),
        "purchase": of("purchase"),
    }
    return CL.union_events(branches).select("event_id", "user_id", "product_id", "event_type", "ts")


@query(
    "row_hash",
    sql(
        "users",
        "SELECT user_id, md5(concat_ws(chr(31), coalesce(email, chr(0)), coalesce(name, chr(0)), coalesce(status, chr(0)))) AS row_hash FROM users",
    ),
)
def row_hash(c):
    return MG.add_row_hash(c.users(), ["email", "name", "status"]).select("user_id", "row_hash")


@query(
    "upsert_latest",
    "SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 'updated' ELSE o_orderstatus END AS status, "
    "CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated_at FROM orders "
    "UNION ALL SELECT -o_orderkey - 1, 'updated', o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderkey % 100 = 0",
)
def upsert_latest(c):
    """A third of the orders get an update, half of those an older one; some keys are new."""
    target = c.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("updated_at")
    )
    day = F.expr("interval 1 day")
    changed = target.where("order_id % 3 = 0").select(
        "order_id",
        F.lit("updated").alias("status"),
        F.when(F.col("order_id") % 2 == 1, F.col("updated_at") + day).otherwise(F.col("updated_at") - day).alias("updated_at"),
    )
    new = target.where("order_id % 100 = 0").select(
        (-F.col("order_id") - 1).alias("order_id"), F.lit("updated").alias("status"), (F.col("updated_at") + day).alias("updated_at")
    )
    return MG.upsert(target, changed.unionByName(new), "order_id", "updated_at")


STATUS_HISTORY = """WITH v AS (SELECT o_custkey AS user_id, o_orderstatus AS status, o_orderdate + to_microseconds(o_orderkey) AS since FROM orders),
    ch AS (SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY since) AS prev FROM v) WHERE prev IS NULL OR prev <> status)
    SELECT user_id, status, since AS valid_from, lead(since) OVER (PARTITION BY user_id ORDER BY since) AS valid_to,
    lead(since) OVER (PARTITION BY user_id ORDER BY since) IS NULL AS is_current, md5(status) AS row_hash FROM ch"""


def status_changes(c):
    """Customer statuses at the times of their orders."""
    return c.table("orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_orderkey") / 1e6).cast("decimal(18,6)"))).alias("at"),
    )


@query("scd2_merge", STATUS_HISTORY)
def scd2_merge(c):
    """Customer status history: orders up to 1997 build the table, later ones are merged, then merged again."""
    updates = status_changes(c)
    split = F.lit("1998-01-01").cast("timestamp")
    first = MG.merge_scd2(None, updates.where(F.col("at") < split), "user_id", ["status"], "at", cell_seconds=30 * 86400)
    later = updates.where(F.col("at") >= split)
    second = MG.merge_scd2(first, later, "user_id", ["status"], "at", cell_seconds=30 * 86400)
    return MG.merge_scd2(second, later, "user_id", ["status"], "at", cell_seconds=30 * 86400).drop("at")


@query("scd2_table", STATUS_HISTORY)
def scd2_table(c):
    """The same history kept as a table: two merges in time, then the changes that were held back, which come late."""
    path, updates = work_dir(c.spark, "history"), status_changes(c)
    split, late = F.lit("1998-01-01").cast("timestamp"), F.col("user_id") % 50 == 7
    held_back = late & (F.month("at") == 3)
    for batch in (updates.where((F.col("at") < split) & ~held_back), updates.where((F.col("at") >= split) & ~held_back), updates.where(held_back)):
        KD.apply_changes(c.spark, path, batch, "user_id", ["status"], "at", buckets=8, cell_seconds=30 * 86400)
    return KD.read_history(c.spark, path).drop("at")


@query(
    "upsert_table",
    "SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 'updated' ELSE o_orderstatus END AS status, "
    "CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated_at FROM orders",
)
def upsert_table(c):
    """Orders kept as a keyed table; a third of them get an update, half of those an older one."""
    path = work_dir(c.spark, "keyed-orders")
    rows = c.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("updated_at")
    )
    day = F.expr("interval 1 day")
    at = F.when(F.col("order_id") % 2 == 1, F.col("updated_at") + day).otherwise(F.col("updated_at") - day)
    for batch in (rows, rows.where("order_id % 3 = 0").select("order_id", F.lit("updated").alias("status"), at.alias("updated_at"))):
        KD.upsert_table(c.spark, path, batch, "order_id", "updated_at", buckets=8)
    return KD.read_keyed(c.spark, path)


@query(
    "overwrite_partition_rerun",
    "SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN value * 2 ELSE value END AS value, CAST(ts AS DATE) AS event_date FROM events",
)
def overwrite_partition_rerun(c):
    """Events by day; one day is computed anew and replaced, twice."""
    path = work_dir(c.spark, "daily-events")
    events = c.table("events").select("event_id", "event_type", "value", F.to_date("ts").alias("event_date"))
    VS.replace_partitions(events, path, ["event_date"])
    day = events.where(F.col("event_date") == F.lit("2024-01-15").cast("date")).withColumn("value", F.col("value") * 2)
    for _ in range(2):
        VS.replace_partitions(day, path, ["event_date"])
    return VS.read_table(c.spark, path)


@query("overwrite_table_schema", "SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0")
def overwrite_table_schema(c):
    """A table replaced by one with other columns; a repeat under the same mark is recognised and does nothing."""
    path, users = work_dir(c.spark, "replaced"), c.table("customer")
    VS.replace_table(users.select(F.col("c_custkey").alias("user_id"), "c_acctbal"), path)
    new = users.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    VS.replace_table(new, path, mark=("daily", 1))
    VS.replace_table(new.limit(0), path, mark=("daily", 1))
    return VS.read_table(c.spark, path)


@query(
    "retention_filter",
    "SELECT event_type, count(*) AS events FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) FROM events) - 10 GROUP BY 1",
)
def retention_filter(c):
    events = c.events().withColumn("event_type", F.when(F.col("event_type") == "clicks", "click").when(F.col("event_type") == "cart", "view").when(F.col("event_type") == "search", "signup").otherwise(F.col("event_type")))
    newest = events.agg(F.max("event_date")).scalar()
    return MG.retain(events, "event_date", 10, newest).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "scan_partition_pruned",
    "SELECT event_type, count(*) AS events, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY ALL",
)
def scan_partition_pruned(c):
    """Events written by day, one day read back."""
    path = work_dir(c.spark, "bronze-events")
    MG.overwrite_partitions(c.table("events").withColumn("event_date", F.to_date("ts")), path, ["event_date"])
    day = read_bronze(c.spark, path, "2024-01-15")
    return day.groupBy("event_type", "event_date").agg(F.count(F.lit(1)).alias("events"))


@query(
    "csv_file_acceptance",
    "SELECT p_brand AS brand, count(*) AS rows, count(*) FILTER (p_partkey % 500 = 7) AS bad_rows, "
    "count(*) FILTER (p_partkey % 500 = 7) = 0 AS accepted FROM part GROUP BY 1",
)
def csv_file_acceptance(c):
    """Catalogue files per brand, some with a negative price, an extra column and text prices; verdict per brand."""
    path = work_dir(c.spark, "landing-catalog")
    rows = c.table("part").select(
        F.col("p_brand").alias("brand"),
        F.lit("dropped").alias("note"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_partkey") % 500 == 7, -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).alias("price"),
        (F.col("p_size") > 10).alias("available"),
    )
    rows.write.partitionBy("brand").option("header", True).csv(path)
    verdicts = file_verdicts(read_landing_csv(c.spark, path, CATALOG), "catalog")
    brand = F.url_decode(F.regexp_extract(FILE, r"brand=([^/]+)/", 1))
    return (
        verdicts.groupBy(F.url_decode(brand).alias("brand"))
        .agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))
        .withColumn("accepted", F.col("bad_rows") == 0)
    )


@query(
    "csv_model_rows",
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_type AS category, "
    "CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS price, p_size > 10 AS available FROM part",
)
def csv_model_rows(c):
    """Text columns coerced to the catalogue model; unreadable prices become null."""
    text = c.table("part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_partkey") % 9 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        (F.col("p_size") > 10).cast("string").alias("available"),
        F.lit("dropped").alias("note"),
    )
    return coerce(text, CATALOG)


@query(
    "pages_extract",
    r"""SELECT page_id, url, regexp_extract(html, '<html lang="([a-zA-Z-]*)"', 1) AS lang,
    regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS heading,
    CAST((length(html) - length(replace(html, '<a href=', ''))) // 8 AS BIGINT) AS links
    FROM pages WHERE regexp_extract(html, '<title>(.*?)</title>', 1, 's') <> ''""",
)
def pages_extract(c):
    return page_records(c.table("pages"))


@query(
    "product_cards",
    sql(
        "products",
        "SELECT title, price AS price_gbp, CASE product_id % 3 WHEN 0 THEN 'One' WHEN 1 THEN 'Two' ELSE '' END AS rating, "
        "CASE WHEN stock IS NULL THEN '' ELSE 'In stock' END AS availability, 'http://shop.example/' || product_id AS url "
        "FROM products WHERE product_id % 11 <> 0",
    ),
)
def product_cards(c):
    """Catalogue rows written as card markup and read back; every 11th card has no price."""
    from tidewater.sources.pages import extract_products

    price = F.concat(F.lit("£"), F.format_number("price", 2))
    rating = F.when(F.col("product_id") % 3 == 0, "One").when(F.col("product_id") % 3 == 1, "Two")
    html = F.concat(
        F.lit('<html><body><article class="product_pod"><h3><a href="x" title="'),
        F.col("title"),
        F.lit('">..</a></h3>'),
        F.coalesce(F.concat(F.lit('<p class="star-rating '), rating, F.lit('"></p>')), F.lit("")),
        F.when(F.col("product_id") % 11 != 0, F.concat(F.lit('<p class="price_color">'), price, F.lit("</p>"))).otherwise(F.lit("")),
        F.when(F.col("stock").isNotNull(), F.lit('<p class="instock availability"><i class="icon-ok"></i>\n  In stock\n</p>')).otherwise(F.lit("")),
        F.lit("</article></body></html>"),
    )
    pages = c.products().select(F.concat(F.lit("http://shop.example/"), F.col("product_id").cast("string")).alias("url"), html.alias("html"))
    return extract_products(pages)
