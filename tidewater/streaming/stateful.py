"""Stateful streams: dedup, rates, sessions, merges into silver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.keyed import BUCKETS, apply_changes
from tidewater.operators.latest import latest_per_key
from tidewater.operators.merge import merge_partitions
from tidewater.operators.timecells import CELL, DAY, cell_of


def dedup(events: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First row per key; repeats are recognised for ``delay`` of event time, which bounds the state.

    Rows that come later than that are dropped; ``settle_dedup`` finds them again in the written rows.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def rate_per_minute(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", by: tuple[str, ...] = ()) -> DataFrame:
    """Events per tumbling minute, optionally per group; emitted once a minute is closed.

    ``settle_rates`` adds the minutes still open and the rows that came too late.
    """
    counts = events.withWatermark(ts, delay).groupBy(F.window(ts, "1 minute"), *by).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(F.col("window.start").alias("minute"), *by, "events")


def session_windows(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions with a fixed gap, emitted when closed.

    The gap is exact here, while the batch sessions count whole minutes.
    The session of ``get_spark`` merges sessions inside each task before the
    shuffle, so a busy user arrives as sessions and not as events.
    ``settle_sessions`` adds open sessions and the rows that came too late.
    """
    sessions = events.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), user).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return sessions.select(
        user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "event_count"
    )


def _per_batch(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, trigger_seconds: int | None) -> StreamingQuery:
    trigger = {"availableNow": True} if trigger_seconds is None else {"processingTime": f"{trigger_seconds} seconds"}
    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_merge(
    df: DataFrame, path: str, checkpoint: str, key: str, order_col: str, partition_col: str, trigger_seconds: int | None = None
) -> StreamingQuery:
    """Upsert each micro-batch into a partitioned silver table; read it with ``versions.read_table``.

    A batch is reduced per key first and rewrites only the partitions it
    touches. It is published together with its number, so a batch that is run
    again after a crash is either whole and recognised or not there at all.
    """

    def merge(batch: DataFrame, number: int) -> None:
        reduced = latest_per_key(batch, [key], [order_col]).persist()  # read twice: touched days, rows
        try:
            merge_partitions(batch.sparkSession, path, reduced, key, order_col, partition_col, mark=(checkpoint, number))
        finally:
            reduced.unpersist()

    return _per_batch(df, merge, checkpoint, trigger_seconds)


def stream_scd2(
    df: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    tracked: Sequence[str],
    effective_ts: str,
    buckets: int = BUCKETS,
    cell_seconds: int = DAY,
    trigger_seconds: int | None = None,
) -> StreamingQuery:
    """Changes into a history table, batch by batch; read it with ``keyed.read_history``.

    Changes may come in any order and be cut into batches anywhere: after each
    batch the table is the history of all changes so far. There is no watermark
    and so nothing that comes too late.
    """

    def apply(batch: DataFrame, number: int) -> None:
        apply_changes(batch.sparkSession, path, batch, key, tracked, effective_ts, buckets, cell_seconds, mark=(checkpoint, number))

    return _per_batch(df, apply, checkpoint, trigger_seconds)


def settle_rates(emitted: DataFrame, written: DataFrame, ts: str = "ts", by: tuple[str, ...] = ()) -> DataFrame:
    """Counts per minute as the written rows have them: closed minutes, the still open ones, and those that rows came late for.

    ``state`` says what a minute was in the stream: ``emitted``, ``open`` (not
    emitted yet, or missed) or ``late`` (emitted with fewer rows). Restrict both
    sides to the days since the last run; the count is one aggregation over them.
    """
    keys = ["minute", *by]
    there = written.groupBy(F.date_trunc("minute", ts).alias("minute"), *by).agg(F.count(F.lit(1)).alias("events"))
    known = emitted.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("events").alias("_events"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    state = F.when(F.col("_events").isNull(), "open").when(F.col("_events") == F.col("events"), "emitted").otherwise("late")
    return there.join(known, same, "left").select(*keys, "events", state.alias("state"))


def settle_sessions(emitted: DataFrame, written: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """Sessions as the written rows have them, open ones and late rows included.

    A user whose emitted sessions hold as many events as were written is settled:
    their sessions are taken over. The others' events are put into sessions again,
    on cells as wide as the gap: two events in one cell are in one session, so the
    first and last time and the number per cell decide, and no event is sorted.
    """
    counts = written.groupBy(user).agg(F.count(F.lit(1)).alias("_written"))
    summed = emitted.groupBy(F.col(user).alias("_user")).agg(F.sum("event_count").alias("_emitted"))
    behind = counts.join(summed, F.col(user).eqNullSafe(F.col("_user")), "left").where(F.coalesce("_emitted", F.lit(0)) != F.col("_written"))
    behind = behind.select(F.col(user).alias("_behind"))
    of_behind = F.col(user).eqNullSafe(F.col("_behind"))
    settled = emitted.join(behind, of_behind, "left_anti").withColumn("state", F.lit("emitted"))
    cells = written.join(behind, of_behind, "left_semi").groupBy(user, cell_of(ts, gap_seconds).alias(CELL))
    cells = cells.agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"), F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy(user).orderBy(CELL)
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    starts = F.coalesce((F.col("_from") > F.lag("_to").over(line) + gap).cast("int"), F.lit(1))
    sessions = cells.withColumn("_start", starts).withColumn("_session", F.sum("_start").over(line)).groupBy(user, "_session")
    sessions = sessions.agg(F.min("_from").alias("session_start"), (F.max("_to") + gap).alias("session_end"), F.sum("_n").alias("event_count"))
    return settled.unionByName(sessions.drop("_session").withColumn("state", F.lit("settled")).select(*settled.columns))


def settle_dedup(emitted: DataFrame, written: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: what the stream let through, and for keys it dropped as late the first written row by ``order``."""
    missed = written.join(emitted.select(key), key, "left_anti").select(*emitted.columns)
    rest = [c for c in emitted.columns if c != key]
    first = missed.groupBy(key).agg(F.min(F.struct(*order, F.struct(*rest).alias("_row"))).alias("_first"))
    return emitted.unionByName(first.select(key, "_first._row.*"))
