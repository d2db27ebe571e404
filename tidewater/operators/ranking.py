"""Global ranks without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import pin

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def with_global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank", total: str = "total") -> DataFrame:
    """Adds the 1-based position in a total order, and the row count.

    One range shuffle sorts the rows; partition sizes give the offsets. The
    sorted rows are pinned first, because partition bounds are sampled and a
    second evaluation could cut elsewhere. The offsets have one row per shuffle
    partition, which bounds both the broadcast and the window over them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pin(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", _LOCAL_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select(
        "_part",
        (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(F.lit(0))).alias(total),
    )
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + local + 1)
        .drop("_id", "_part", "_before")
    )


def tile_of(rank: Column | str, total: Column | str, tiles: int) -> Column:
    """NTILE number of a rank: the first ``total mod tiles`` tiles hold one row more."""
    r = (F.col(rank) if isinstance(rank, str) else rank) - 1
    n = F.col(total) if isinstance(total, str) else total
    small = F.floor(n / tiles)
    extra = n % tiles
    in_large = extra * (small + 1)
    return F.when(r < in_large, F.floor(r / (small + 1))).otherwise(
        extra + F.floor((r - in_large) / F.greatest(small, F.lit(1)))
    ).cast("int") + 1


def with_ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str) -> DataFrame:
    """Adds NTILE(``tiles``) over a total order."""
    ranked = with_global_rank(df, order, "_rank", "_total")
    return ranked.withColumn(name, tile_of("_rank", "_total", tiles)).drop("_rank", "_total")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Top ``k`` rows per group; Spark keeps at most k per group and task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def with_running_totals(df: DataFrame, order: Sequence[Column], measures: dict[str, Column]) -> DataFrame:
    """Adds, per measure, the inclusive running sum over a total order.

    Sorted and pinned like ``with_global_rank``. The window inside a range
    partition and the sums of the partitions before it add up to the whole.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    raw = {name: f"_m_{name}" for name in measures}
    ordered = pin(
        df.withColumns({raw[n]: m for n, m in measures.items()})
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(*[F.sum(c).alias(c) for c in raw.values()])
        .select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in raw.values()])
    )
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ordered.join(F.broadcast(offsets), "_part")
    for name, c in raw.items():
        out = out.withColumn(name, F.col(f"_b{c}") + F.sum(c).over(inside))
    return out.drop("_id", "_part", *raw.values(), *[f"_b{c}" for c in raw.values()])


def exact_percentile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One row ``cut``: the percentile with linear interpolation, by global position.

    Rows are counted per value first, so a value that many rows share is one row of the sort.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    upto = with_running_totals(values, [F.col("x")], {"upto": F.col("n")})
    position = upto.agg(F.max("upto")).scalar() - 1
    low = F.floor(position * p)
    weight = position * p - low
    at_low = F.min(F.when(F.col("upto") >= low + 1, F.col("x")))
    at_high = F.min(F.when(F.col("upto") >= low + 2, F.col("x")))
    return upto.agg(at_low.alias("_lo"), at_high.alias("_hi"), F.max(weight).alias("_w")).select(
        (F.col("_lo") + F.coalesce(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * F.col("_w")).alias("cut")
    )
