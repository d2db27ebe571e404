"""Sessions: runs of a user's events without a gap of more than N whole minutes.

Two events of one user inside the same N-minute cell are always in one session.
So the cells' first and last times decide all session borders exactly, and the
ordered window runs over cells, never over raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import complete_minutes, complete_seconds, surrogate_key
from tidewater.operators.ranking import top_per_group
from tidewater.operators.timecells import CELL, cell_of


def _numbered(cells: DataFrame, gap_minutes: int, user: str, first: str, last: str) -> DataFrame:
    """Cells with their session number, counted from 1 per user."""
    timeline = Window.partitionBy(user).orderBy(CELL)
    before = F.lag(last).over(timeline)
    starts = F.when(before.isNull() | (complete_minutes(before, first) > gap_minutes), 1).otherwise(0)
    return cells.withColumn("_starts", starts).withColumn("session_num", F.sum("_starts").over(timeline)).drop("_starts")


def session_map(events: DataFrame, gap_minutes: int = 30, user: str = "user_id", ts: str = "event_ts") -> DataFrame:
    """(user, cell) to session number."""
    cells = (
        events.where(F.col(user).isNotNull())
        .groupBy(user, cell_of(ts, gap_minutes * 60).alias(CELL))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    return _numbered(cells, gap_minutes, user, "_first", "_last").select(user, CELL, "session_num")


def tag_sessions(events: DataFrame, gap_minutes: int = 30, user: str = "user_id", ts: str = "event_ts") -> DataFrame:
    """Events with their session number; the join splits skewed partitions under AQE."""
    tagged = events.where(F.col(user).isNotNull()).withColumn(CELL, cell_of(ts, gap_minutes * 60))
    return tagged.join(session_map(events, gap_minutes, user, ts), [user, CELL])


def session_facts(events: DataFrame, gap_minutes: int = 30, with_sequence: bool = True) -> DataFrame:
    """One row per session with counts, conversion and, if asked, the item sequence.

    Input: event_id, user_id, session_id, event_ts, event_type, product_id.
    The sequence keeps nulls and is one array value, so it is bound by Spark's
    2 GB per row; without it every step is a partial aggregate, and
    ``tag_sessions`` gives the same items as rows.
    """
    rows = events.where(F.col("user_id").isNotNull()).withColumn(CELL, cell_of("event_ts", gap_minutes * 60))
    keys = ["user_id", CELL]
    of_type = lambda t: F.count(F.when(F.col("event_type") == t, 1))
    scalars = [
        F.min("session_id").alias("raw_session_id"),
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        of_type("purchase").alias("purchases"),
        of_type("cart").alias("cart_actions"),
    ]
    mapped = session_map(events, gap_minutes)
    group = ["user_id", "session_num"]
    merged = [
        F.min("raw_session_id").alias("raw_session_id"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("event_count").alias("event_count"),
        F.sum("purchases").alias("purchases"),
        F.sum("cart_actions").alias("cart_actions"),
    ]
    if with_sequence:
        item = F.struct("event_ts", "event_id", "product_id")
        cells = rows.groupBy(*keys).agg(*scalars, F.collect_list(item).alias("_items")).join(mapped, keys)
        ordered = F.array_sort(F.flatten(F.collect_list("_items")))
        per_session = (
            cells.groupBy(*group)
            .agg(*merged, F.transform(ordered, lambda x: x["product_id"]).alias("product_sequence"))
            .withColumn("distinct_products_viewed", F.size(F.array_distinct(F.array_compact("product_sequence"))).cast("long"))
        )
    else:
        cells = _numbered(rows.groupBy(*keys).agg(*scalars), gap_minutes, "user_id", "session_start", "session_end")
        per_session = cells.groupBy(*group).agg(*merged)
        products = rows.where(F.col("product_id").isNotNull()).groupBy(*keys, "product_id").agg(F.lit(1).alias("_one"))
        distinct = (
            products.join(mapped, keys)
            .groupBy(*group, "product_id")
            .agg(F.lit(1).alias("_one"))
            .groupBy(*group)
            .agg(F.count(F.lit(1)).alias("distinct_products_viewed"))
        )
        per_session = per_session.join(distinct, group, "left").withColumn(
            "distinct_products_viewed", F.coalesce("distinct_products_viewed", F.lit(0).cast("long"))
        )
    computed_id = F.concat_ws("_", F.col("user_id").cast("string"), F.col("session_num").cast("string"))
    out = per_session.select(
        surrogate_key("user_id", "session_num").alias("session_sk"),
        F.coalesce("raw_session_id", computed_id).alias("session_id"),
        "user_id",
        "session_num",
        "session_start",
        "session_end",
        complete_seconds("session_start", "session_end").alias("duration_seconds"),
        "event_count",
        "distinct_products_viewed",
        "purchases",
        "cart_actions",
        (F.col("purchases") > 0).alias("converted"),
        *(["product_sequence"] if with_sequence else []),
    )
    return out


def last_items(events: DataFrame, gap_minutes: int = 30, max_items: int = 50, min_length: int = 1) -> DataFrame:
    """(session_sk, user_id, items): the last ``max_items`` items of every session that has ``min_length``, in order.

    Every task keeps the last items per session before the shuffle, so a session
    of any length arrives as at most ``max_items`` rows a task and never as one array.
    """
    if min_length > max_items:
        raise ValueError("min_length is above max_items")
    group = ["user_id", "session_num"]
    items = tag_sessions(events, gap_minutes).where(F.col("product_id").isNotNull()).select(*group, "event_ts", "event_id", "product_id")
    newest = top_per_group(items, group, [F.col("event_ts").desc(), F.col("event_id").desc()], max_items)
    in_order = F.array_sort(F.collect_list(F.struct("event_ts", "event_id", "product_id")))
    rows = newest.groupBy(*group).agg(in_order["product_id"].alias("items")).where(F.size("items") >= min_length)
    return rows.select(surrogate_key(*group).alias("session_sk"), "user_id", "items")


def item_transitions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Consecutive item pairs inside sessions: user, session, item, next item.

    Pairs inside a cell come from a window over (user, session, cell); pairs that
    cross cells come from each cell's first and last item.
    """
    items = tag_sessions(events, gap_minutes).where(F.col("product_id").isNotNull())
    group = ["user_id", "session_num"]
    inside = Window.partitionBy(*group, CELL).orderBy("event_ts", "event_id")
    within = items.select(
        *group, F.col("product_id").alias("item"), F.lead("product_id").over(inside).alias("next_item")
    ).where(F.col("next_item").isNotNull())
    point = F.struct("event_ts", "event_id", "product_id")
    edges = items.groupBy(*group, CELL).agg(F.min(point).alias("_head"), F.max(point).alias("_tail"))
    across = edges.select(
        *group,
        F.col("_tail.product_id").alias("item"),
        F.lead("_head").over(Window.partitionBy(*group).orderBy(CELL))["product_id"].alias("next_item"),
    ).where(F.col("next_item").isNotNull())
    return within.unionByName(across)
