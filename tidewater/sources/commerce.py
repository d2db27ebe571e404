"""The commerce tables, built from the sample star schema. Only this module knows it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.joins import in_parts, parts_for

# Payment method per order priority.
METHODS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "pix",
    "3-MEDIUM": "boleto",
    "4-NOT SPECIFIED": "debit_card",
}
OTHER_METHOD = "wallet"


def _case(c: str, mapping: dict[str, str], default: Column | None = None) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(F.col(c) == key, value) if out is None else out.when(F.col(c) == key, value)
    return out.otherwise(default) if default is not None else out


@dataclass(frozen=True)
class Commerce:
    """Domain tables over one folder of sample Parquet files."""

    spark: SparkSession
    base: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}.parquet")

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("user_id"),
            F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
            F.concat(F.lit("USER"), key.cast("string"), F.lit("@Shop.example ")).alias("email"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "SELLER").otherwise("BUYER").alias("user_type"),
            F.when(key % 7 == 0, "F").when(key % 7 == 1, "M").when(key % 7 == 2, "NB").alias("gender"),
            F.when(key % 5 != 0, "active").alias("status"),
            F.date_sub(F.lit("1995-01-01").cast("date"), (key % 1000).cast("int")).cast("timestamp").alias("created_at"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("price"),
            F.when(F.col("p_partkey") % 13 != 0, F.col("p_size")).alias("stock"),
            (F.col("p_partkey") % 100).alias("seller_id"),
        )

    def line_parts(self) -> int | None:
        """Tasks for what has a row per order line; None where the shuffle setting gives as many."""
        return parts_for(self.table("lineitem"))

    def order_lines(self, parts: int | None = None) -> DataFrame:
        """Order grain with one product per row, joined in ``parts`` tasks."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"
        )
        status = (
            F.when(F.col("l_returnflag") == "R", "REFUNDED")
            .when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "P", "PAID")
            .when(F.col("l_linestatus") == "O", "CREATED")
            .otherwise("SHIPPED")
        )
        lines, orders = in_parts(lines, parts, "l_orderkey"), in_parts(orders, parts, "o_orderkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("total_amount"),
            status.alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
        )

    def orders(self) -> DataFrame:
        """Order header grain."""
        key = F.col("o_orderkey")
        created = F.col("o_orderdate").cast("timestamp")
        status = _case("o_orderstatus", {"F": "completed", "P": "pending"}, F.lit("processing"))
        return self.table("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            status.alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            F.lit("BRL").alias("currency"),
            _case("o_orderpriority", METHODS, F.lit(OTHER_METHOD)).alias("payment_method"),
            (key % 7 + 1).cast("int").alias("items_count"),
            created.alias("created_at"),
            F.when(
                F.col("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), (key % 15).cast("int")).cast("timestamp")
            ).alias("completed_at"),
        )

    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        seconds = F.make_dt_interval(secs=(key * 7919 % 86400).cast("decimal(18,6)"))
        return self.table("orders").select(
            key.alias("payment_id"),
            F.when(key % 50 != 0, key).alias("order_id"),
            F.col("o_totalprice").alias("amount"),
            _case("o_orderpriority", METHODS, F.lit(OTHER_METHOD)).alias("method"),
            _case("o_orderstatus", {"F": "CONFIRMED", "P": "FAILED"}, F.lit("PENDING")).alias("status"),
            (F.col("o_orderdate").cast("timestamp") + seconds).alias("created_at"),
        )

    def events(self) -> DataFrame:
        """Behaviour events; searches and errors carry no product."""
        kind = F.col("event_type")
        product = F.get_json_object("props", "$.k").try_cast("bigint")
        return self.table("events").select(
            "event_id",
            "user_id",
            F.when(kind == "view", F.concat(F.lit("w"), F.col("user_id").cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string"))).alias("session_id"),
            F.when(kind.isin("click", "view", "purchase"), product).alias("product_id"),
            _case("event_type", {"click": "clicks", "view": "cart", "signup": "search"}, kind).alias("event_type"),
            F.col("props").alias("payload"),
            F.col("ts").cast("timestamp").alias("event_ts"),
            F.to_date("ts").alias("event_date"),
            "value",
        )

    def cdc_orders(self) -> DataFrame:
        """Kafka-shaped change rows: each order created, a third updated, a tenth deleted, a few unreadable."""
        key = F.col("o_orderkey")
        created = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
        seen = F.col("o_orderdate").cast("timestamp")

        def image(status: Column, at: Column) -> Column:
            return F.to_json(
                F.struct(
                    key.cast("string").alias("id"),
                    F.col("o_custkey").alias("buyer_id"),
                    F.col("o_totalprice").alias("total_amount"),
                    status.alias("status"),
                    at.cast("string").alias("created_at"),
                )
            )

        first = image(F.lit("CREATED"), created).alias("first")
        later = image(F.when(F.col("o_orderstatus") == "F", "DELIVERED").otherwise("SHIPPED"), created).alias("later")
        none = F.lit(None).cast("string")

        def change(n: int, op: str, before: Column, after: Column, when: Column) -> Column:
            body = F.to_json(
                F.struct(
                    F.lit(op).alias("op"),
                    (created + n * 60_000).cast("string").alias("ts_ms"),
                    before.alias("before"),
                    after.alias("after"),
                )
            )
            text = F.when((key % 97 == 0) & F.lit(n == 0), F.lit("{bad")).otherwise(body)
            return F.when(when, F.struct(F.lit(n).alias("n"), text.alias("body")))

        updated = key % 3 == 0
        deleted = key % 10 == 0
        changes = F.array_compact(
            F.array(
                change(0, "c", none, F.col("first"), F.lit(True)),
                change(1, "u", F.col("first"), F.col("later"), updated),
                change(2, "d", F.when(updated, F.col("later")).otherwise(F.col("first")), none, deleted),
            )
        )
        return (
            self.table("orders")
            .select(key, "o_orderdate", first, later)
            .select(key, seen.alias("seen"), F.explode(changes).alias("c"))
            .select(
                F.col("o_orderkey").cast("string").cast("binary").alias("key"),
                F.col("c.body").cast("binary").alias("value"),
                F.lit("cdc.orders").alias("topic"),
                (F.col("o_orderkey") % 8).cast("int").alias("partition"),
                (F.col("o_orderkey") * 4 + F.col("c.n")).alias("offset"),
                (F.col("seen") + F.make_dt_interval(mins=F.col("c.n"))).alias("timestamp"),
            )
        )
