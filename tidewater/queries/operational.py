"""Captured tables rebuilt from their changes, silver tables merged into targets, landed files and gates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import cdc as C
from tidewater.operators import keyed as KD
from tidewater.operators import quality as Q
from tidewater.operators.merge import overwrite_partitions
from tidewater.plans import operational as OP
from tidewater.plans import schemas as SC
from tidewater.plans import silver as SI
from tidewater.plans import star as S
from tidewater.queries.oracle import sessions_sql, sql
from tidewater.queries.registry import query
from tidewater.session import work_dir
from tidewater.sources import bronze as BR
from tidewater.sources import landing as L
from tidewater.streaming.bronze import parse_raw_event

CREATED = "2024-01-01T00:00:00Z"


def captured(rows: DataFrame, key: Column, first: Column, later: Column, changed: Column) -> DataFrame:
    """Bronze rows of a table: every row created, the ``changed`` ones updated later, read through the envelope.

    The update comes first in the topic, so that only the change time tells which image is the latest.
    """

    def message(n: int, op: str, image: Column) -> Column:
        body = F.struct(F.lit(op).alias("op"), F.lit(str(1_700_000_000_000 + n * 60_000)).alias("ts_ms"), F.to_json(image).alias("after"))
        return F.struct(F.lit(n).alias("n"), F.to_json(body).alias("body"))

    both = F.when(changed, F.array(message(1, "u", later), message(0, "c", first))).otherwise(F.array(message(0, "c", first)))
    sent = rows.select(key.alias("k"), F.explode(both).alias("m"))
    return C.parse_envelope(
        sent.select(
            F.col("k").cast("string").cast("binary").alias("key"),
            F.col("m.body").cast("binary").alias("value"),
            F.lit("cdc").alias("topic"),
            (F.col("k") % 4).cast("int").alias("partition"),
            (F.col("k") * 2 - F.col("m.n")).alias("offset"),
            F.lit("2024-01-02").cast("timestamp").alias("timestamp"),
        )
    )


@query(
    "dim_users_operational",
    sql(
        "users",
        "SELECT user_id, name, CASE WHEN user_id % 3 = 0 THEN 'new' || user_id || '@x.example' ELSE email END AS email, user_type, created_at, "
        "created_at + to_days(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END) AS updated_at FROM users",
    ),
)
def dim_users_operational(c):
    key, at = F.col("user_id"), F.col("created_at")
    image = lambda email, days: F.struct(
        key.alias("id"), "name", email.alias("email"), "user_type",
        F.unix_millis(at).cast("string").alias("created_at"), F.unix_millis(at + F.make_dt_interval(days=F.lit(days))).cast("string").alias("updated_at"),
    )
    rows = captured(c.users(), key, image(F.col("email"), 0), image(F.concat(F.lit("new"), key.cast("string"), F.lit("@x.example")), 1), key % 3 == 0)
    return OP.dim_users(rows)


@query(
    "dim_products_operational",
    sql(
        "products",
        "SELECT product_id, seller_id, title, category, price, CASE WHEN product_id % 4 = 0 THEN 0 ELSE stock END AS stock, "
        "TIMESTAMP '2024-01-01' AS created_at FROM products",
    ),
    ints="stock",
)
def dim_products_operational(c):
    key = F.col("product_id")
    image = lambda stock: F.struct(
        key.alias("id"), "seller_id", "title", "category", "price", stock.alias("stock"), F.lit(CREATED).alias("created_at")
    )
    rows = captured(c.products(), key, image(F.col("stock")), image(F.lit(0)), key % 4 == 0)
    return OP.dim_products(rows).select("product_id", "seller_id", "title", "category", "price", "stock", "created_at")


@query(
    "fact_payments_operational",
    sql(
        "pays",
        "SELECT payment_id, order_id, amount, method, CASE WHEN payment_id % 5 = 0 THEN 'PENDING' ELSE status END AS status, created_at, "
        "CASE WHEN payment_id % 5 <> 0 THEN created_at + INTERVAL 1 HOUR END AS processed_at FROM pays",
    ),
)
def fact_payments_operational(c):
    """Payments created pending, four in five decided an hour later."""
    key, at = F.col("payment_id"), F.col("created_at")
    millis = lambda ts: F.unix_millis(ts).cast("string")
    image = lambda status, done: F.struct(
        key.alias("id"), "order_id", "amount", "method", status.alias("status"), millis(at).alias("created_at"), done.alias("processed_at")
    )
    rows = captured(
        c.payments(), key, image(F.lit("PENDING"), F.lit(None).cast("string")),
        image(F.col("status"), millis(at + F.make_dt_interval(hours=F.lit(1)))), key % 5 != 0,
    )
    return OP.fact_payments(rows)


@query(
    "notifications_from_cdc",
    "SELECT CAST(ts AS DATE) AS notif_date, CASE WHEN event_id % 3 = 0 THEN 'sms' WHEN event_id % 2 = 0 THEN 'email' ELSE 'push' END AS channel, event_type, "
    "count(*) AS notifications FROM events WHERE event_type IN ('signup', 'error') GROUP BY ALL",
)
def notifications_from_cdc(c):
    """Notifications per day from their changes; a third are sent again by another channel and count once, there."""
    key = F.col("event_id")
    image = lambda channel: F.struct(
        key.alias("id"), "user_id", channel.alias("channel"), "event_type", F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("created_at")
    )
    rows = c.table("events").where("event_type IN ('signup', 'error')")
    first = image(F.when(key % 2 == 0, "email").otherwise("push"))
    return OP.notifications(captured(rows, key, first, image(F.lit("sms")), key % 3 == 0))


@query(
    "silver_products",
    """SELECT product_id, title, price, status, valid_from, CASE WHEN n = 1 AND p_partkey % 2 = 0 THEN TIMESTAMP '2024-02-01' END AS valid_to,
    n = 2 OR p_partkey % 2 = 1 AS is_current FROM (
    SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, CAST(p_retailprice AS DECIMAL(15, 2)) AS price, 'active' AS status, 1 AS n, TIMESTAMP '2024-01-01' AS valid_from FROM part
    UNION ALL SELECT p_partkey, CAST(p_partkey AS VARCHAR), p_name, CAST(p_retailprice AS DECIMAL(15, 2)), 'paused', 2, TIMESTAMP '2024-02-01' FROM part WHERE p_partkey % 2 = 0)""",
)
def silver_products(c):
    """Product versions kept as a history table: creation, then a batch that pauses every second one and repeats the others."""
    key, path = F.col("p_partkey"), work_dir(c.spark, "silver-products")

    def image(status, at):
        return F.struct(
            key.cast("string").alias("product_id"), F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("title"),
            F.col("p_retailprice").cast("string").alias("price"), F.lit(status).alias("status"), F.lit(CREATED).alias("created_at"), F.lit(at).alias("updated_at"),
        )

    for status, at, which in (("active", CREATED, key >= 0), ("paused", "2024-02-01T00:00:00Z", key % 2 == 0), ("active", CREATED, key % 2 == 1)):
        rows = c.table("part").where(which)
        batch = SI.product_updates(captured(rows, key, image(status, at), image(status, at), F.lit(False)))
        KD.apply_changes(c.spark, path, batch, "product_id", SC.PRODUCT_TRACKED, "updated_at", buckets=8)
    return KD.read_history(c.spark, path).select("product_id", "title", "price", "status", "valid_from", "valid_to", "is_current")


@query(
    "silver_events",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'purchase' END AS event_type, "
    "CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 1 MINUTE ELSE ts END AS ts FROM events WHERE event_type IN ('click', 'purchase')",
)
def silver_events(c):
    """Clicks in the target, purchases and later versions of every tenth click merged into it."""
    events = c.table("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    of = lambda kind: events.where(F.col("event_type") == kind).drop("event_type")
    again = lambda df: df.where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 minute"))
    target = SI.silver_events(None, {"clicks": of("click")})
    merged = SI.silver_events(target, {"clicks": again(of("click")), "purchase": of("purchase").unionByName(again(of("purchase")))})
    return merged.select("event_id", "user_id", "event_type", "ts")


@query(
    "raw_domain_events",
    "SELECT 'stock_alert' AS event_name, CAST(p_partkey AS VARCHAR) AS record_key, '{\"product_id\":' || p_partkey || ',\"stock\":' || p_size || '}' AS payload_json, "
    "CAST(p_partkey % 4 AS INTEGER) AS kafka_partition, p_partkey AS kafka_offset, 'stock-alert' AS kafka_topic, DATE '2024-01-02' AS event_date FROM part",
)
def raw_domain_events(c):
    key = F.col("p_partkey")
    raw = c.table("part").select(
        key.cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(key.alias("product_id"), F.col("p_size").alias("stock"))).cast("binary").alias("value"),
        F.lit(BR.DOMAIN_TOPICS["stock_alert"]).alias("topic"),
        (key % 4).cast("int").alias("partition"),
        key.cast("long").alias("offset"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("timestamp"),
    )
    return parse_raw_event(raw, "stock_alert").select("event_name", "record_key", "payload_json", "kafka_partition", "kafka_offset", "kafka_topic", "event_date")


@query(
    "addresses_rows",
    "SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, c_name AS logradouro, n_name AS localidade FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def addresses_rows(c):
    """Customers landed as JSON arrays, one a nation, and read back; postal codes lose dot and dash."""
    path, code = work_dir(c.spark, "landing-addresses"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    dotted = F.concat(F.substring(code, 1, 2), F.lit("."), F.substring(code, 3, 3), F.lit("-"), F.substring(code, 6, 3))
    rows = c.table("customer").join(c.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    each = F.to_json(F.struct(dotted.alias("cep"), F.col("c_name").alias("logradouro"), F.col("n_name").alias("localidade")))
    arrays = rows.groupBy("n_nationkey").agg(F.concat(F.lit("["), F.array_join(F.collect_list(each), ",\n"), F.lit("]")).alias("value"))
    arrays.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return L.load_addresses(c.spark, path).select("cep", "logradouro", "localidade")


@query(
    "landed_files",
    "SELECT brand, count(*) AS rows, (SELECT count(*) FROM (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) FILTER (p_partkey % 500 = 7) = 0)) AS accepted_files, "
    "true AS checked, DATE '2024-01-05' AS event_date FROM (SELECT *, p_brand AS brand FROM part) "
    "WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) FILTER (p_partkey % 500 = 7) = 0) GROUP BY brand",
)
def landed_files(c):
    """Catalogue files per brand landed into a day; files with a negative price stay out, the number accepted is returned."""
    landing, bronze = work_dir(c.spark, "landing"), work_dir(c.spark, "bronze")
    price = F.when(F.col("p_partkey") % 500 == 7, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))
    rows = c.table("part").select(
        F.col("p_brand").alias("brand"), F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("category"), price.alias("price"), (F.col("p_size") > 10).alias("available"),
    )
    rows.repartition("brand").write.partitionBy("brand").option("header", True).csv(f"{landing}/catalog")
    accepted = L.land_csv(c.spark, landing, bronze, "catalog", "2024-01-05")
    day = L.read_landed(c.spark, bronze, "catalog", "2024-01-05")
    return day.groupBy(F.col("category").alias("brand"), "checked", "event_date").agg(F.count(F.lit(1)).alias("rows")).withColumn("accepted_files", F.lit(accepted).cast("long"))


@query(
    "optional_and_named_tables",
    "SELECT 'gold' AS layer, count(*) AS rows, CAST(NULL AS BIGINT) AS missing FROM customer UNION ALL SELECT 'bronze', count(*), 0 FROM nation",
)
def optional_and_named_tables(c):
    """A gold table read by name, a bronze table that may be absent and is not, and one that is."""
    root = work_dir(c.spark, "layers")
    c.table("customer").write.parquet(f"{root}/gold/customers")
    overwrite_partitions(c.table("nation").withColumn("event_date", F.lit("2024-01-01").cast("date")), f"{root}/bronze/nation", ["event_date"])
    gold = BR.read_table(c.spark, "gold", "customers", root).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("gold").alias("layer"), "rows", F.lit(None).cast("long").alias("missing"))
    there, absent = BR.read_optional(c.spark, f"{root}/bronze/nation"), BR.read_optional(c.spark, f"{root}/bronze/none")
    count = F.lit(0 if absent is None else 1).cast("long").alias("missing")
    return gold.unionByName(there.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("bronze").alias("layer"), "rows", count))


_SHIPPED = {
    "silver_orders": (Q.SILVER_ORDERS, lambda c: c.orders()),
    "gold_fact_orders": (Q.GOLD_FACT_ORDERS, lambda c: gold_orders(c)),
    "gold_dim_users": (Q.GOLD_DIM_USERS, lambda c: S.dim_users(c.users())),
    "gold_dim_products": (Q.GOLD_DIM_PRODUCTS, lambda c: S.dim_products(c.products())),
    "gold_dim_date": (Q.GOLD_DIM_DATE, lambda c: S.dim_date(c.spark, "1995-01-01", "2003-01-01")),
    "gold_fact_events": (Q.GOLD_FACT_EVENTS, lambda c: c.events()),
    "gold_fact_sessions": (Q.GOLD_FACT_SESSIONS, lambda c: S.fact_sessions(c.events(), with_sequence=False)),
    "silver_users": (Q.SILVER_USERS, lambda c: SI.silver_users(None, user_images(c))),
    "bronze_users": (Q.BRONZE_USERS, lambda c: user_images(c)),
}


def gold_orders(c):
    return S.fact_orders(c.orders(), S.dim_users(c.users()), S.dim_date(c.spark, "1995-01-01", "2003-01-01"))


def user_images(c):
    """Changes of users whose silver rows meet their suite, but that every 100th has no @ in the address."""
    key = F.col("user_id")
    email = F.when(key % 100 == 99, F.lit("nobody")).otherwise(F.col("email"))
    image = F.struct(
        key.cast("string").alias("user_id"), email.alias("email"), "name", "status", F.lit(CREATED).alias("created_at"), F.lit(CREATED).alias("updated_at")
    )
    return captured(c.users(), key, image, image, F.lit(False))


@query(
    "shipped_suites",
    sql(
        "users heads products ev",
        """SELECT suite, rules, failed, CAST(failing AS BIGINT) AS failing FROM (
        SELECT 'bronze_users' AS suite, 9 AS rules, 0 AS failed, 0 AS failing UNION ALL
        SELECT 'silver_users', 10, CAST(n > 0 AS INT), n FROM (SELECT count(*) AS n FROM users WHERE user_id % 100 = 99) UNION ALL
        SELECT 'silver_orders', 8, CAST(n > 0 AS INT), n FROM (SELECT count(*) AS n FROM heads WHERE total_amount <= 0) UNION ALL
        SELECT 'gold_fact_orders', 9, CAST(n > 0 AS INT), n FROM (SELECT count(*) AS n FROM heads WHERE total_amount <= 0) UNION ALL
        SELECT 'gold_dim_users', 6, 0, 0 UNION ALL SELECT 'gold_dim_products', 5, 0, 0 UNION ALL SELECT 'gold_dim_date', 6, 0, 0 UNION ALL
        SELECT 'gold_fact_events', 4, CAST(n > 0 AS INT), n FROM (SELECT count(*) AS n FROM ev WHERE event_type NOT IN ('clicks', 'cart', 'search', 'purchase', 'sessions', 'reviews')) UNION ALL
        SELECT 'gold_fact_sessions', 5, CAST(n > 0 AS INT), n FROM (SELECT coalesce(sum(k), 0) AS n FROM (SELECT count(*) AS k FROM sess GROUP BY session_id HAVING count(*) > 1)))""",
        sessions_sql(30),
    ),
    ints="rules failed",
)
def shipped_suites(c):
    """All nine declared suites on their tables: rules, failed rules and failing rows."""
    out = None
    for name, (rules, table) in _SHIPPED.items():
        done = Q.run_suite(table(c), rules).agg(
            F.count(F.lit(1)).cast("int").alias("rules"), F.count_if(~F.col("passed")).cast("int").alias("failed"), F.sum("failing").alias("failing")
        ).select(F.lit(name).alias("suite"), "rules", "failed", "failing")
        out = done if out is None else out.unionByName(done)
    return out


@query(
    "gate_outcome",
    sql("heads", "SELECT layer, CASE WHEN n = 0 THEN 'passed' WHEN layer = 'bronze' THEN 'reported' ELSE 'stopped' END AS outcome, "
        "CASE WHEN n > 0 THEN 'in_set(status)' ELSE '' END AS failed FROM (SELECT count(*) FILTER (status = 'processing') AS n FROM heads), "
        "(VALUES ('bronze'), ('silver'), ('gold')) v(layer)"),
)
def gate_outcome(c):
    """One failing suite at the gate of every layer: bronze reports, silver and gold stop the build."""
    results = Q.run_suite(c.orders(), (Q.not_null("order_id"), Q.in_set("status", ("completed", "pending")))).persist()
    rows = []
    for layer in ("bronze", "silver", "gold"):
        try:
            failed = Q.gate(results, layer)
            rows.append((layer, "reported" if failed else "passed", ", ".join(failed)))
        except Q.QualityGateError as error:
            rows.append((layer, "stopped", str(error).split(": ", 1)[1]))
    results.unpersist()
    return c.spark.createDataFrame(rows, "layer string, outcome string, failed string")
