"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from tidewater import functions as X
from tidewater.sources.landing import explode_rates, postal_digits
from tidewater.queries.registry import joined, query, rounded


@query(
    "scalar_strings",
    r"""SELECT c_custkey AS user_id, lower(trim(' ' || c_name || ' ')) AS cleaned, replace(replace(substr(c_name, 10, 6) || '-' || '0.1', '-', ''), '.', '') AS postal,
    regexp_matches(CASE WHEN c_custkey % 3 = 0 THEN 'a@b.c' ELSE 'a@b' END, '^[^@]+@[^@]+\.[^@]+$') AS is_email,
    md5(concat_ws('-', CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '_dbt_utils_surrogate_key_null_' END)) AS sk,
    CASE c_custkey % 4 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'many' END AS label,
    CASE WHEN lower(c_mktsegment) = 'building' THEN 1 ELSE 0 END AS is_building, CASE WHEN lower(c_mktsegment) = 'household' THEN 1 ELSE 0 END AS is_household
    FROM customer""",
)
def scalar_strings(c):
    key = F.col("c_custkey")
    return c.table("customer").select(
        key.alias("user_id"),
        F.lower(F.trim(F.concat(F.lit(" "), "c_name", F.lit(" ")))).alias("cleaned"),
        postal_digits(F.concat(F.substring("c_name", 10, 6), F.lit("-"), F.lit("0.1"))).alias("postal"),
        F.when(key % 3 == 0, "a@b.c").otherwise("a@b").rlike(r"^[^@]+@[^@]+\.[^@]+$").alias("is_email"),
        X.surrogate_key("c_custkey", F.when(key % 2 == 0, F.col("c_mktsegment"))).alias("sk"),
        X.label_map((key % 4).cast("string"), {"0": "zero", "1": "one"}, "many").alias("label"),
        *X.one_hot("c_mktsegment", ("building", "household"), "is_"),
    )


@query(
    "scalar_dates",
    """SELECT event_id, hour(ts) AS hour, dayofweek(ts) + 1 AS dow, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk, weekofyear(ts) AS week,
    dayname(ts) AS day_name, date_sub('minute', ts, TIMESTAMP '2024-02-01') AS minutes_left, date_sub('second', ts, TIMESTAMP '2024-02-01') AS seconds_left,
    round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts))) / 86400.0 + 1e-9, 6) AS days_left, CAST(ts AS DATE) >= DATE '2024-01-25' AS last_week FROM events""",
    ints="hour dow week",
)
def scalar_dates(c):
    end = F.lit("2024-02-01").cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    out = c.table("events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        F.dayofweek(ts).alias("dow"),
        X.date_key(ts).alias("date_sk"),
        F.weekofyear(ts).alias("week"),
        F.date_format(ts, "EEEE").alias("day_name"),
        X.complete_minutes(ts, end).alias("minutes_left"),
        X.complete_seconds(ts, end).alias("seconds_left"),
        X.fractional_days(ts, end).alias("days_left"),
        X.last_days(ts, 7, end).alias("last_week"),
    )
    return rounded(out, days_left=6)


@query(
    "scalar_json",
    "SELECT currency, count(*) AS snapshots, round(sum(rate), 2) AS rate_sum FROM (SELECT p_partkey, unnest(['BRL', 'EUR']) AS currency, "
    "unnest([p_retailprice, p_size * 1.0]) AS rate FROM part WHERE p_partkey % 5 <> 0) GROUP BY 1",
)
def scalar_json(c):
    """Rate snapshots written as JSON text, parsed with a map of rates and exploded."""
    from tidewater.sources.landing import RATES

    rates = F.create_map(F.lit("BRL"), F.col("p_retailprice"), F.lit("EUR"), F.col("p_size").cast("double"))
    status = F.when(F.col("p_partkey") % 5 == 0, "error").otherwise("success")
    text = F.to_json(F.struct(status.alias("result"), F.lit("USD").alias("base_code"), rates.alias("rates")))
    snapshots = c.table("part").select(F.from_json(text, RATES).alias("s")).select("s.*")
    out = explode_rates(snapshots).groupBy("currency").agg(F.count(F.lit(1)).alias("snapshots"), F.sum("rate").alias("rate_sum"))
    return rounded(out, rate_sum=2)


@query(
    "scalar_arrays",
    """SELECT o_orderkey AS order_id, array_to_string(padded, ',') AS padded, target, n AS length FROM (
    SELECT o_orderkey, list_concat(inputs, list_resize([]::BIGINT[], 4 - len(inputs), 0)) AS padded, target, CAST(len(inputs) AS INTEGER) AS n FROM (
    SELECT o_orderkey, list_slice(seq, greatest(len(seq) - 3, 1), len(seq) - 1) AS inputs, seq[len(seq)] AS target
    FROM (SELECT o_orderkey, [o_custkey, o_orderkey, o_custkey + 1, o_orderkey + 1, o_custkey + 2][1:CAST(2 + o_orderkey % 4 AS INTEGER)] AS seq FROM orders)))""",
)
def scalar_arrays(c):
    """Sequences of two to five numbers cut to the last four, split into padded input and target."""
    user, order = F.col("o_custkey"), F.col("o_orderkey")
    seq = F.slice(F.array(user, order, user + 1, order + 1, user + 2), F.lit(1), (order % 4 + 2).cast("int"))
    sample = X.session_sample("seq", 4)
    rows = c.table("orders").select(order.alias("order_id"), seq.alias("seq")).select("order_id", sample.alias("s"))
    return rows.select("order_id", joined("s.input").alias("padded"), F.col("s.target").alias("target"), F.col("s.length").alias("length"))
