"""Left joins of facts to dimensions whose key is often null, and the number of tasks for large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 256


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, spread_by: str, spread: int = NULL_SPREAD) -> DataFrame:
    """Left join on ``fact_key = dim_key``; the dimension's key column is dropped.

    Rows without a key match nothing, but a shuffle join would send them all to
    one task. A second join column, 0 wherever there is a key, sends them to
    ``spread`` groups by the hash of ``spread_by`` (a column that varies, such
    as the row's id). Hot keys that do exist are split by AQE's skew join.
    """
    left = fact.withColumn(
        "_spread", F.when(F.col(fact_key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int") + 1).otherwise(0)
    )
    right = dim.withColumnRenamed(dim_key, "_dim_key").withColumn("_dim_spread", F.when(F.col("_dim_key").isNull(), -1).otherwise(0))
    on = (F.col(fact_key) == F.col("_dim_key")) & (F.col("_spread") == F.col("_dim_spread"))
    return left.join(right, on, "left").drop("_spread", "_dim_spread", "_dim_key")


#: Rows that one task of a large join or grouping should hold.
ROWS_PER_TASK = 250_000


def parts_for(rows: DataFrame) -> int | None:
    """Tasks for ``rows`` of about ROWS_PER_TASK each; None where the shuffle setting gives as many.

    Counts a stored table, which reads footers and no columns.
    """
    parts = -(-rows.count() // ROWS_PER_TASK)
    return parts if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def in_parts(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by its keys into ``parts`` tasks, so that what a task holds does not grow with the table; None leaves it to Spark."""
    return df if parts is None else df.repartition(parts, *keys)
