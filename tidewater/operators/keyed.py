"""Keyed tables whose merges read and move only what the updates touch.

Rows lie in buckets, ranges of a key hash that are partition directories. The
directory is the summary of the keys in its files: a merge opens the buckets of
its keys and no other. Inside them, rows of other keys are copied in place by
the task that reads them; only rows of updated keys meet the updates in a shuffle.
A history that gets changes of more keys than can be sent to every task lays
its buckets out whole instead: one shuffle in place of two joins.

A history (SCD type 2) keeps three kinds of rows apart. ``open`` has the current
version per key, ``closed`` the ended ones, ``echo`` the changes that changed
nothing. Changes later than all a key has seen need the open row alone: closed
versions are appended, never read. A change that comes late splits a version or
moves a border, so the keys concerned, and only they, are laid out again from
their closed and echo rows. The table therefore equals the history of all
changes together, whatever batches they came in and in whatever order.

Writes go through ``versions``: readers see a merge whole or not at all, and a
batch that carries a mark is applied once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions import row_hash
from tidewater.operators import versions
from tidewater.operators.latest import latest_per_key, require_columns
from tidewater.operators.timecells import CELL_ROWS, DAY, with_runs

BUCKET, SIDE, LAST = "_bucket", "_side", "_last_seen"
OPEN, CLOSED, ECHO = "open", "closed", "echo"
#: Buckets of a new table. A bucket should hold some hundred MB, and a batch touch few of them.
BUCKETS = 64
#: Distinct keys of a batch up to which they are sent to every task; more are joined by a shuffle.
BROADCAST_KEYS = 200_000


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _buckets_of(base: versions.Version) -> int:
    """The number of buckets a table was made with, kept among its marks."""
    return base.marks["buckets"]


def _checked(keys: DataFrame, n: int) -> DataFrame:
    return F.broadcast(keys) if n <= BROADCAST_KEYS else keys


def _extent(keys: DataFrame, key: str, buckets: int) -> tuple[int, set[int]]:
    """How many rows (one a key) there are, and which buckets they lie in: at most one number a bucket comes to the driver."""
    row = keys.agg(F.count(F.lit(1)), F.collect_set(bucket_of(key, buckets))).first()
    return row[0], set(row[1])


def _in(unit: str, level: str, values: set) -> bool:
    return any(f"{level}={v}" in unit.split("/") for v in values)


def upsert_table(
    spark: SparkSession, path: str, updates: DataFrame, key: str, order_col: str, buckets: int = BUCKETS, mark: tuple[str, int] | None = None
) -> bool:
    """Newest row per key over the table and the updates; at equal times the update wins.

    Rows without a key have no place in a keyed table and are left out. False
    where the mark shows that this batch has been merged before.
    """
    require_columns(updates, [key, order_col], "upsert_table")
    base = versions.current(spark, path)
    if versions.seen(base, mark):
        return False
    n = _buckets_of(base) if base else buckets
    fresh = latest_per_key(updates.where(F.col(key).isNotNull()), [key], [order_col]).withColumn(BUCKET, bucket_of(key, n)).persist()
    try:
        if base is None:
            rows = fresh
        else:
            n_keys, touched = _extent(fresh, key, n)
            there = versions.read_table(spark, path, base, lambda unit: _in(unit, BUCKET, touched))
            keys = _checked(fresh.select(key), n_keys)
            met = there.join(keys, key, "left_semi").withColumn(SIDE, F.lit(0)).unionByName(fresh.withColumn(SIDE, F.lit(1)), allowMissingColumns=True)
            newest = latest_per_key(met, [key], [order_col, SIDE]).drop(SIDE)
            rows = there.join(keys, key, "left_anti").unionByName(newest.hint("rebalance", BUCKET), allowMissingColumns=True)
        return _publish(rows, path, [BUCKET], lambda unit: True, (), base, mark, n)
    finally:
        fresh.unpersist()


def _publish(rows: DataFrame, path: str, by: list[str], replaces: Callable[[str], bool], emptied: Sequence[str], base: versions.Version | None, mark: tuple[str, int] | None, n: int) -> bool:
    if base is None:  # the number of buckets is remembered with the table
        base = versions.Version(0, rows.schema, tuple(by), {}, {"buckets": n})
    versions.write_version(rows, path, by, replaces, emptied, mark=mark, base=base)
    return True


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_table(spark, path).drop(BUCKET)


def _sided(runs: DataFrame, payload: Sequence[str]) -> DataFrame:
    side = F.when(~F.col("_starts"), ECHO).when(F.col("_until").isNull(), OPEN).otherwise(CLOSED)
    return runs.withColumn(SIDE, side).select(*payload, "valid_from", F.col("_until").alias("valid_to"), "row_hash", LAST, SIDE)


def _layout(points: DataFrame, payload: Sequence[str], key: str) -> DataFrame:
    """Versions and echoes of complete sets of change points (key, valid_from, row_hash, payload, last seen), with their side: one shuffle by key.

    Of several points of a key at one instant the greatest counts.
    """
    line = Window.partitionBy(key).orderBy("valid_from", "row_hash", *[c for c in payload if c != key])
    back = Window.partitionBy(key).orderBy(F.col("valid_from").desc())
    once = points.withColumn("_next", F.lead("valid_from").over(line)).where(F.col("_next").isNull() | (F.col("_next") != F.col("valid_from")))
    marked = once.withColumn("_prev", F.lag("row_hash").over(line)).withColumn("_starts", F.col("_prev").isNull() | (F.col("_prev") != F.col("row_hash")))
    ahead = F.last(F.when(F.col("_starts"), F.col("valid_from")), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    last = F.max(F.greatest(LAST, "valid_from")).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = marked.withColumns({"_until": ahead, LAST: last}).withColumn("_until", F.when(F.col("_starts"), F.col("_until")))
    sided = _sided(runs, payload)
    return sided.withColumn(LAST, F.when(F.col(SIDE) == OPEN, F.col(LAST)))


def _layout_by_cells(points: DataFrame, payload: Sequence[str], key: str, cell_seconds: int) -> DataFrame:
    """The same where a key has more points than one task should hold."""
    last = points.groupBy(key).agg(F.max(F.greatest(LAST, "valid_from")).alias(LAST))
    runs = with_runs(points.drop(LAST), key, "valid_from", ["valid_from", "row_hash"], "row_hash", cell_seconds)
    laid = _sided(runs.withColumn(LAST, F.lit(None).cast("timestamp")), payload)
    opened = laid.where(F.col(SIDE) == OPEN).drop(LAST).join(last, key)
    return laid.where(F.col(SIDE) != OPEN).unionByName(opened)


def apply_changes(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective_ts: str,
    buckets: int = BUCKETS,
    cell_seconds: int = DAY,
    mark: tuple[str, int] | None = None,
) -> bool:
    """Add changes, several per key and in any order, to the history in ``path``.

    A version starts where the hash of the tracked columns changes and ends
    where the next one starts. Of several changes of a key at one instant the
    one with the greatest hash counts. Changes without a key or a time have no
    place in a history and are left out. False where the mark shows that this
    batch has been applied; without a mark, applying it again changes nothing either.
    """
    require_columns(updates, [key, effective_ts, *tracked], "apply_changes")
    base = versions.current(spark, path)
    if versions.seen(base, mark):
        return False
    n = _buckets_of(base) if base else buckets
    payload = [key, *[c for c in updates.columns if c != key]]
    columns = [*payload, "valid_from", "row_hash", LAST]
    fresh = updates.withColumns({"valid_from": F.col(effective_ts).cast("timestamp"), "row_hash": row_hash(*tracked), LAST: F.lit(None).cast("timestamp")})
    fresh = fresh.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(*columns).persist()
    held = [fresh]
    try:
        first = fresh.groupBy(key).agg(F.min("valid_from").alias("_first"), F.count(F.lit(1)).alias("_n")).persist()
        held.append(first)
        n_keys, touched, most = first.agg(F.count(F.lit(1)), F.collect_set(bucket_of(key, n)), F.max("_n")).first()
        points, copied, late_buckets = fresh, [], set()
        if base is not None:

            def side(name: str, within: set) -> DataFrame:
                return versions.read_table(spark, path, base, lambda unit: _in(unit, SIDE, {name}) and _in(unit, BUCKET, within))

            def meet(old: DataFrame, keys: DataFrame, few: bool) -> None:
                """Rows of ``keys`` become points, others are copied; where the keys are many, every row becomes a point."""
                nonlocal points
                if few:
                    copied.append(old.join(F.broadcast(keys), key, "left_anti"))
                    old = old.join(F.broadcast(keys), key, "left_semi")
                seen = F.col(LAST) if LAST in old.columns else F.lit(None).cast("timestamp").alias(LAST)
                points = points.unionByName(old.select(*columns[:-1], seen))

            opened = side(OPEN, set(touched))
            meet(opened, first.select(key), n_keys <= BROADCAST_KEYS)
            known = opened.select(key, F.col(LAST).alias("_known"))
            late = known.join(_checked(first.select(key, "_first"), n_keys), key).where(F.col("_first") <= F.col("_known")).select(key).persist()
            held.append(late)
            n_late, late_buckets = _extent(late, key, n)
            for name in (CLOSED, ECHO) if n_late else ():
                meet(side(name, late_buckets), late, n_late <= BROADCAST_KEYS)
            most = points.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] if n_late else (most or 0) + 1
        if (most or 0) > CELL_ROWS:
            points = latest_per_key(points, [key, "valid_from"], ["row_hash", LAST]).persist()
            held.append(points)
            laid = _layout_by_cells(points, payload, key, cell_seconds)
        else:
            laid = _layout(points, payload, key)
        rows = laid.withColumn(BUCKET, bucket_of(key, n)).hint("rebalance", SIDE, BUCKET)
        for old in copied:
            rows = rows.unionByName(old, allowMissingColumns=True)
        again = {f"{SIDE}={name}/{BUCKET}={b}" for name in (CLOSED, ECHO) for b in late_buckets}
        return _publish(rows, path, [SIDE, BUCKET], lambda unit: _in(unit, SIDE, {OPEN}) or unit in again, sorted(again), base, mark, n)
    finally:
        for df in held:
            df.unpersist()


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions with ``valid_from``, ``valid_to``, ``is_current`` and ``row_hash``."""
    table = versions.read_table(spark, path, keep=lambda unit: _in(unit, SIDE, {OPEN, CLOSED}))
    rest = ("valid_from", "valid_to", "row_hash", LAST, SIDE, BUCKET)
    payload = [c for c in table.columns if c not in rest]
    return table.select(*[f"`{c}`" for c in payload], "valid_from", "valid_to", (F.col(SIDE) == OPEN).alias("is_current"), "row_hash")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current versions; closed ones are not opened."""
    table = versions.read_table(spark, path, keep=lambda unit: _in(unit, SIDE, {OPEN}))
    return table.drop("valid_to", LAST, SIDE, BUCKET)
