"""Upsert, history (SCD type 2), retention and table writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import row_hash
from tidewater.operators import versions
from tidewater.operators.latest import latest_per_key, require_columns
from tidewater.operators.timecells import DAY, with_runs
from tidewater.session import pin

SCD2_COLUMNS = ("valid_from", "valid_to", "is_current", "row_hash")


def add_row_hash(df: DataFrame, cols: Sequence[str], name: str = "row_hash") -> DataFrame:
    return df.withColumn(name, row_hash(*cols))


def upsert(target: DataFrame | None, updates: DataFrame, key: str, order_col: str) -> DataFrame:
    """Newest row per key over target and updates; at equal times the update wins."""
    require_columns(updates, [key, order_col], "upsert")
    rows = updates.withColumn("_side", F.lit(1))
    if target is not None:
        rows = target.withColumn("_side", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    return latest_per_key(rows, [key], [order_col, "_side"]).drop("_side")


def merge_scd2(
    target: DataFrame | None,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective_ts: str,
    open_end: Column | None = None,
    cell_seconds: int = DAY,
) -> DataFrame:
    """Full history after applying updates, several per key allowed.

    A version starts when the hash of the tracked columns changes and ends when
    the next one starts. Updates at or before the start of the current version
    are already applied and ignored, which makes a rerun a no-op. Versions
    closed earlier pass through untouched.
    """
    require_columns(updates, [key, effective_ts, *tracked], "merge_scd2")
    payload = updates.columns
    fresh = add_row_hash(updates, tracked).withColumn("valid_from", F.col(effective_ts)).where(F.col(key).isNotNull())
    fresh = latest_per_key(fresh, [key, "valid_from"], ["row_hash"])
    # What is pinned has the size of the updates; closed versions are only copied, never joined or sorted.
    fresh = pin(fresh)
    kept, timeline = None, fresh
    if target is not None:
        keys = fresh.select(key).distinct()
        current = target.where("is_current")
        touched = pin(current.join(keys, key, "left_semi").select(*payload, "row_hash", "valid_from"))
        known = touched.select(key, F.col("valid_from").alias("_since"))
        new = fresh.join(known, key, "left").where(F.col("_since").isNull() | (F.col("valid_from") > F.col("_since")))
        timeline = touched.unionByName(new.drop("_since"))
        kept = target.where(~F.col("is_current")).unionByName(current.join(keys, key, "left_anti"))
    runs = with_runs(timeline, key, "valid_from", ["valid_from", "row_hash"], "row_hash", cell_seconds)
    high = open_end if open_end is not None else F.lit(None)
    opened = runs.where("_starts").select(
        *payload,
        "valid_from",
        F.coalesce("_until", high).cast("timestamp").alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
        "row_hash",
    )
    opened = pin(opened)
    return opened if kept is None else kept.select(*opened.columns).unionByName(opened)


def retain(df: DataFrame, date_col: str, days: int, as_of: Column) -> DataFrame:
    """Rows of the last ``days`` days; on a partition column this prunes directories."""
    return df.where(F.col(date_col) >= F.date_sub(as_of, days))


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return the number of rows, observed on the way instead of counted again."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table bucketed and sorted by its join key.

    Two tables with the same key and bucket count join without a shuffle. Worth
    it for the large pairs that are joined in every build, like orders and lines.
    """
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``, in the plain layout that any Parquet reader understands.

    A crash between the removal of old files and the arrival of new ones loses
    rows until the write is repeated; ``versions.replace_partitions`` does not.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def merge_partitions(
    spark: SparkSession, path: str, updates: DataFrame, key: str, order_col: str, partition_col: str, mark: tuple[str, int] | None = None
) -> bool:
    """Upsert into a partitioned table of ``versions``, rewriting only the partitions the updates touch.

    The partition column must be fixed per key (an event or creation date).
    Readers see the merge whole or not at all; False where ``mark`` shows that it has been done.
    """
    base = versions.current(spark, path)
    if versions.seen(base, mark):
        return False
    existing = None
    if base is not None:
        touched = updates.select(F.col(partition_col).alias("_touched")).distinct()
        there = versions.read_table(spark, path, base)
        existing = there.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
    merged = upsert(existing, updates, key, order_col).select(*updates.columns)
    versions.write_version(merged, path, [partition_col], replaces=lambda unit: True, mark=mark, base=base)
    return True


def table_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
