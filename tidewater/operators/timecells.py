"""Ordered per-entity operators that never put one entity into one task.

A window over ``partitionBy(entity)`` sends a busy entity, however large, to a
single task. The operators here cut each entity's time line into cells of a
fixed width. Work inside a cell is a window over (entity, cell). What a cell
needs from earlier or later ones comes from a summary with one row per
(entity, cell): it is aggregated map-side, so its size depends on the time
span and not on the number of rows.

A cell may still be hot: one entity with a third of all rows in an hour. The
summary says so. Then the times that cut the hot cells into equal parts are
taken from a mergeable quantile sketch and the cells concerned become many, so
that no task holds more than about ``cell_rows`` rows of one entity; only rows
of one entity at one single instant cannot be parted by time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import micros
from tidewater.session import pin

DAY = 86_400
HOUR = 3_600

CELL = "_cell"


def cell_of(ts: Column | str, seconds: int) -> Column:
    """Number of the time cell an instant falls in."""
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("long")


#: Rows of an entity that may share a cell before the cell is cut.
CELL_ROWS = 500_000
#: Parts a hot cell is cut into.
PARTS = 1024
_WAY = 32  # parts are found in two steps of this many comparisons
#: Hot cells whose cuts may be broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 500


def _cut(celled: DataFrame, hot: DataFrame, few: bool, entity: str, at: Column) -> DataFrame:
    """Rows with every cell numbered in steps of PARTS, those in ``hot`` cells by the part their time is in."""
    names = hot.select(F.struct(entity).alias("_hot_key"), F.col(CELL).alias("_hot_cell"))

    def in_hot(other: DataFrame, how: str) -> DataFrame:
        return celled.join(F.broadcast(other) if few else other, (F.struct(entity) == F.col("_hot_key")) & (F.col(CELL) == F.col("_hot_cell")), how)

    shares = [i / PARTS for i in range(1, PARTS)]
    cuts = in_hot(names, "inner").groupBy("_hot_key", "_hot_cell").agg(F.percentile_approx(at, shares, 20 * PARTS).alias("_cuts"))
    marked = in_hot(pin(cuts), "left")
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.lit(PARTS // _WAY - 1)), lambda i: F.element_at("_cuts", i * _WAY)), lambda c: c < at))
    fine = F.size(F.filter(F.slice("_cuts", F.col("_coarse") * _WAY + 1, F.lit(_WAY - 1)), lambda c: c < at))
    marked = marked.withColumn("_coarse", F.when(F.col("_cuts").isNotNull(), coarse))
    part = F.coalesce(F.col("_coarse") * _WAY + fine, F.lit(0))
    return marked.withColumn(CELL, F.col(CELL) * PARTS + part).drop("_hot_key", "_hot_cell", "_cuts", "_coarse")


def summarised(celled: DataFrame, entity: str, at: Column, aggregates: Sequence[Column], cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows with cells of bounded size, and per (entity, cell) the aggregates and the number of ``_rows``.

    ``at`` is the time in microseconds. The summary is pinned: it is small, read
    more than once, and says whether a cell has to be cut.
    """

    def per_cell(rows: DataFrame) -> DataFrame:
        return pin(rows.groupBy(entity, CELL).agg(F.count(F.lit(1)).alias("_rows"), *aggregates))

    summary = per_cell(celled)
    hot = summary.where(F.col("_rows") > cell_rows).select(entity, CELL)
    n = hot.count()
    if n:
        celled = _cut(celled, hot, n <= BROADCAST_CELLS, entity, at)
        summary = per_cell(celled)
    return celled, summary


def with_prior_totals(
    df: DataFrame,
    entity: str,
    ts: str,
    order: Sequence[str],
    measures: Mapping[str, Column],
    cell_seconds: int = DAY,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Adds, per row, the sum of each measure over the entity's earlier rows.

    ``order`` starts with ``ts`` and must be total; the row itself is not counted.
    """
    raw = {name: f"_m_{name}" for name in measures}
    celled = df.withColumns({CELL: cell_of(ts, cell_seconds), **{raw[n]: m for n, m in measures.items()}})
    celled, totals = summarised(celled, entity, micros(ts), [F.sum(c).alias(c) for c in raw.values()], cell_rows)
    earlier_cells = Window.partitionBy(entity).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(entity, CELL, *[F.sum(raw[n]).over(earlier_cells).alias(f"_c_{n}") for n in measures])
    same_cell = Window.partitionBy(entity, CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = celled.join(carried, [entity, CELL], "left")
    for name in measures:
        inside = F.coalesce(F.sum(raw[name]).over(same_cell), F.lit(0))
        out = out.withColumn(name, F.when(F.col(entity).isNotNull(), F.coalesce(f"_c_{name}", F.lit(0)) + inside).otherwise(F.lit(0)))
    return out.drop(CELL, *raw.values(), *[f"_c_{n}" for n in measures])


def with_trailing_count(df: DataFrame, entity: str, ts: str, seconds: int, name: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Adds the number of the entity's rows in the ``seconds`` up to and with each row.

    Cells are as wide as the look-back, so a row needs its own cell and the one
    before: (entity, ts) pairs are sent on to the next cell as context. Where a
    cell is hot, the count is the difference of two running totals instead, of
    the rows up to now and of those up to the start of the look-back.
    """
    celled = df.withColumns({CELL: cell_of(ts, seconds), "_at": micros(ts), "_own": F.lit(True)})
    counts = celled.groupBy(entity, CELL).agg(F.count(F.lit(1)).alias("_rows"))
    if not counts.where(F.col("_rows") > cell_rows).isEmpty():
        return _by_running_totals(df, entity, ts, seconds, name, cell_rows)
    context = celled.select(entity, "_at", (F.col(CELL) + 1).alias(CELL), F.lit(False).alias("_own"))
    window = (
        Window.partitionBy(entity, CELL).orderBy("_at").rangeBetween(-seconds * 1_000_000, Window.currentRow)
    )
    return (
        celled.unionByName(context, allowMissingColumns=True)
        .withColumn(name, F.count(F.lit(1)).over(window))
        .where("_own")
        .drop(CELL, "_at", "_own")
    )


def _by_running_totals(df: DataFrame, entity: str, ts: str, seconds: int, name: str, cell_rows: int) -> DataFrame:
    """The trailing count from running totals per instant, whatever one entity does in the look-back."""
    from tidewater.operators.asof import asof_join

    # The key as a struct: rows without an entity count among themselves, as in the window above.
    instants = df.groupBy(F.struct(entity).alias("_k"), F.col(ts).alias("_now")).agg(F.count(F.lit(1)).alias("_n"))
    upto = with_prior_totals(instants.withColumn("_t", F.col("_now").cast("timestamp")), "_k", "_t", ["_t"], {"_before": F.col("_n")}, seconds, cell_rows)
    upto = pin(upto.select("_k", "_now", "_t", (F.col("_before") + F.col("_n")).alias("_upto")))
    spine = upto.withColumn("_start", F.timestamp_micros(micros("_t") - (seconds * 1_000_000 + 1)))
    totals = upto.select("_k", F.col("_t").alias("_then"), F.col("_upto").alias("_gone"))
    counted = asof_join(spine, totals, "_k", "_start", "_then", ["_gone"], cell_seconds=seconds, cell_rows=cell_rows)
    counted = counted.select("_k", "_now", (F.col("_upto") - F.coalesce("_gone", F.lit(0))).alias(name))
    same = (F.struct(entity) == F.col("_k")) & F.col(ts).eqNullSafe(F.col("_now"))
    return df.join(counted, same).drop("_k", "_now")


def with_neighbour(
    df: DataFrame,
    entity: str,
    ts: str,
    order: Sequence[str],
    values: Sequence[str],
    name: str,
    after: bool = False,
    cell_seconds: int = DAY,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Adds struct column ``name`` with ``values`` of the entity's previous (or next) row.

    The struct is null on the entity's first (or last) row. ``order`` must be total.
    """
    celled = df.withColumn(CELL, cell_of(ts, cell_seconds))
    picked = F.struct(*values)
    edge = F.struct(*order, picked.alias("_v"))
    celled, summary = summarised(celled, entity, micros(ts), [(F.min if after else F.max)(edge).alias("_e")], cell_rows)
    inside = Window.partitionBy(entity, CELL).orderBy(*order)
    across = Window.partitionBy(entity).orderBy(CELL)
    if after:
        carried = summary.select(entity, CELL, F.lead("_e").over(across)["_v"].alias("_far"))
        near = F.lead(picked).over(inside)
    else:
        carried = summary.select(entity, CELL, F.lag("_e").over(across)["_v"].alias("_far"))
        near = F.lag(picked).over(inside)
    return (
        celled.join(carried, [entity, CELL], "left")
        .withColumn(name, F.coalesce(near, "_far"))
        .drop(CELL, "_far")
    )


def with_runs(df: DataFrame, entity: str, ts: str, order: Sequence[str], value: str, cell_seconds: int = DAY, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Marks where the value changes along an entity's time line.

    ``_starts`` is true on the first row of every run of equal values, and there
    ``_until`` is the time the next run starts, null on the last. ``order``
    starts with ``ts`` and must be total. One shuffle by entity, unless an
    entity has more than ``cell_rows`` rows: then neighbours are found on cells.
    ``df`` is read twice.
    """
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.struct(value))
    if df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_rows).isEmpty():
        line = Window.partitionBy(entity).orderBy(*order)
        back = Window.partitionBy(entity).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        marked = df.withColumn("_prev", F.lag(F.struct(value)).over(line)).withColumn("_starts", changed)
        ahead = F.last(F.when(F.col("_starts"), F.col(ts)), ignorenulls=True).over(back)
        return marked.withColumn("_until", F.when(F.col("_starts"), ahead)).drop("_prev")
    marked = pin(with_neighbour(df, entity, ts, order, [value], "_prev", cell_seconds=cell_seconds, cell_rows=cell_rows).withColumn("_starts", changed).drop("_prev"))
    starts = with_neighbour(marked.where("_starts"), entity, ts, order, [ts], "_next", after=True, cell_seconds=cell_seconds, cell_rows=cell_rows)
    starts = starts.withColumn("_until", F.col("_next")[ts]).drop("_next")
    return starts.unionByName(marked.where("not _starts"), allowMissingColumns=True)
