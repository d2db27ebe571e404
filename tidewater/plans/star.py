"""Star schema: calendar, dimensions, facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import date_key, label_map, surrogate_key
from tidewater.operators.asof import asof_join
from tidewater.operators.joins import lookup
from tidewater.operators.sessions import session_facts

# Brazilian national holidays with a fixed date (day, month, name).
HOLIDAYS = (
    (1, 1, "Confraternização Universal"),
    (21, 4, "Tiradentes"),
    (1, 5, "Dia do Trabalho"),
    (7, 9, "Independência"),
    (12, 10, "N. Sra. Aparecida"),
    (2, 11, "Finados"),
    (15, 11, "Proclamação da República"),
    (25, 12, "Natal"),
)

# Gender labels.
GENDERS = {"F": "Feminino", "M": "Masculino", "NB": "Não-binário"}
GENDER_UNKNOWN = "Não informado"
UNKNOWN = "unknown"


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Days from ``start`` up to but without ``end``."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))


def spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """Every day between the first and last date of a column."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("full_date"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``full_date`` column; Sunday is day 1 of the week.

    Black Friday is the Friday on 23 to 29 November.
    """
    spark = days.sparkSession
    holidays = spark.createDataFrame(list(HOLIDAYS), "h_day int, h_month int, holiday_name string")
    d = F.col("full_date")
    named = days.join(
        F.broadcast(holidays), (F.dayofmonth(d) == F.col("h_day")) & (F.month(d) == F.col("h_month")), "left"
    )
    return named.select(
        date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        ((F.month(d) == 11) & (F.dayofweek(d) == 6) & F.dayofmonth(d).between(23, 29)).alias("is_black_friday"),
        F.col("holiday_name").isNotNull().alias("is_national_holiday"),
        "holiday_name",
    )


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    return calendar(date_spine(spark, start, end))


def years_between(start: Column, end: Column) -> Column:
    """Complete years between two dates."""
    months = F.months_between(end, start)
    return F.floor(months / 12).cast("int")


def dim_users(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Current users with key, gender label and, where a birth date is known, age."""
    out = users.withColumns(
        {"user_sk": surrogate_key("user_id"), "gender": label_map("gender", GENDERS, GENDER_UNKNOWN)}
    )
    if "birth_date" in users.columns and as_of is not None:
        born = F.col("birth_date").try_cast("date")
        out = out.withColumns({"birth_date": born, "age": years_between(born, F.to_date(as_of))})
    if "valid_from" in users.columns:
        out = out.withColumnRenamed("valid_from", "scd_valid_from")
    return out.select("user_sk", *[c for c in out.columns if c != "user_sk"])


def dim_products(products: DataFrame, stock: str = "stock") -> DataFrame:
    out = products.withColumns(
        {
            "product_sk": surrogate_key("product_id"),
            "stock_status": F.when(F.col(stock) > 0, "in_stock").otherwise("out_of_stock"),
        }
    )
    if "valid_from" in products.columns:
        out = out.withColumnRenamed("valid_from", "scd_valid_from")
    return out.select("product_sk", *[c for c in out.columns if c != "product_sk"])


def _with_user_key(df: DataFrame, users: DataFrame, row_id: str) -> DataFrame:
    keys = users.select(F.col("user_id").alias("_user_id"), "user_sk")
    return lookup(df, keys, "user_id", "_user_id", row_id).withColumn("user_sk", F.coalesce("user_sk", F.lit(UNKNOWN)))


def _with_date_key(df: DataFrame, days: DataFrame, ts: str, name: str) -> DataFrame:
    """Calendar key by day, or the same number computed when the day is outside the calendar."""
    wanted = date_key(ts)
    keyed = df.withColumn("_day", wanted).join(days.select(F.col("date_sk").alias("_sk")), F.col("_day") == F.col("_sk"), "left")
    return keyed.withColumn(name, F.coalesce("_sk", "_day")).drop("_day", "_sk")


def fact_orders(orders: DataFrame, users: DataFrame, days: DataFrame) -> DataFrame:
    """One row per order with dimension keys, completion flag and days to completion."""
    joined = _with_date_key(_with_user_key(orders, users, "order_id"), days, "created_at", "order_date_sk")
    return joined.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id",
        "user_sk",
        "user_id",
        "order_date_sk",
        "status",
        "total_amount",
        "currency",
        "payment_method",
        "items_count",
        "created_at",
        "completed_at",
        F.coalesce(F.col("status") == "completed", F.lit(False)).alias("is_completed"),
        F.datediff(F.to_date("completed_at"), F.to_date("created_at")).alias("fulfillment_days"),
    )


def fact_events(events: DataFrame, users: DataFrame, products: DataFrame, days: DataFrame) -> DataFrame:
    """One row per event with dimension keys; unmatched users and products are 'unknown'."""
    product_keys = products.select(F.col("product_id").alias("_product_id"), "product_sk")
    dated = _with_date_key(_with_user_key(events, users, "event_id"), days, "event_ts", "event_date_sk")
    keyed = lookup(dated, product_keys, "product_id", "_product_id", "event_id").withColumn(
        "product_sk", F.coalesce("product_sk", F.lit(UNKNOWN))
    )
    return keyed.select(
        "event_id",
        "event_type",
        "session_id",
        "user_sk",
        "user_id",
        "product_sk",
        "product_id",
        "event_date_sk",
        "event_ts",
        "event_date",
        "payload",
    )


def fact_sessions(events: DataFrame, gap_minutes: int = 30, with_sequence: bool = True) -> DataFrame:
    return session_facts(events, gap_minutes, with_sequence)


def session_values(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions with the value of the orders placed while they ran.

    An order belongs to the user's latest session started at or before it, if
    that session had not ended.
    """
    bounds = sessions.select("user_id", "session_sk", "session_start", "session_end")
    placed = orders.select("user_id", "created_at", "total_amount").where(F.col("created_at").isNotNull())
    owned = asof_join(placed, bounds, "user_id", "created_at", "session_start", ["session_sk", "session_end"])
    totals = (
        owned.where(F.col("created_at") <= F.col("session_end"))
        .groupBy("session_sk")
        .agg(F.sum("total_amount").alias("total_value"))
    )
    return sessions.join(totals, "session_sk", "left").fillna({"total_value": 0.0})

