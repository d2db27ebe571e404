"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources.commerce import Commerce

Build = Callable[[Commerce], DataFrame]


@dataclass(frozen=True)
class Registered:
    build: Build
    sql: str | None


_QUERIES: dict[str, Registered] = {}


def query(key: str, sql: str | None = None, ints: str = "") -> Callable[[Build], Build]:
    """Register a query with its oracle; ``ints`` names oracle columns that are 32-bit in Spark."""
    if sql and ints:
        casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ints.split())
        sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"

    def register(build: Build) -> Build:
        if key in _QUERIES:
            raise ValueError(f"query {key} registered twice")
        _QUERIES[key] = Registered(build, sql)
        return build

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, which is what the sample tables hold."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _runner(entry: Registered) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(entry.build(Commerce(spark, sf_dir.rstrip("/"))))

    return run


def oracle_of(key: str) -> str:
    """The oracle of a query registered before, to build on."""
    return _QUERIES[key].sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _runner(entry) for key, entry in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: entry.sql for key, entry in _QUERIES.items() if entry.sql is not None}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns, so that the order of additions does not show.

    A tiny step up settles exact halves the same way in both engines.
    """
    return df.withColumns({c: F.round(F.col(c).cast("double") + 1e-9, n) for c, n in digits.items()})


def joined(c: Column | str) -> Column:
    """An array as text, nulls spelled out."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "null")


def as_of(orders: DataFrame, ts: str = "created_at") -> Column:
    """The day after the last date in the data, as a timestamp."""
    return orders.agg(F.date_add(F.to_date(F.max(ts)), 1).cast("timestamp")).scalar()
