"""Point-in-time feature retrieval."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import micros
from tidewater.operators.latest import latest_per_key, require_columns
from tidewater.operators.timecells import CELL, CELL_ROWS, DAY, cell_of, summarised


@dataclass(frozen=True)
class Source:
    """Feature rows for ``asof_join_many``: their time, the columns wanted and how long they are valid."""

    name: str
    rows: DataFrame
    ts: str
    columns: tuple[str, ...]
    ttl_seconds: int | None = None


def asof_join_many(
    spine: DataFrame, sources: Sequence[Source], entity: str, spine_ts: str, cell_seconds: int = DAY, cell_rows: int = CELL_ROWS, whole: bool = False
) -> DataFrame:
    """Each spine row with the latest valid feature row of every source at or before its time.

    Columns come out as ``<source>__<column>``, the feature time as
    ``<source>__ts``. All sources share one order, so the spine is moved once.
    With ``whole`` the rows per entity are counted, and cells are made only
    where one has more than ``cell_rows``: for sources that are cheap to read.
    """
    return _joined(spine, sources, entity, spine_ts, cell_seconds, cell_rows, lambda source, column: f"{source}__{column or 'ts'}", whole)


def _joined(
    spine: DataFrame, sources: Sequence[Source], entity: str, spine_ts: str, cell_seconds: int, cell_rows: int, named: Callable[[str, str], str], whole: bool = False
) -> DataFrame:
    """Spine and features in one order of (entity, time cell).

    The latest feature of earlier cells is carried per source over a summary
    with one row per cell, so no entity is held by one task; with ``whole`` an
    entity is one cell if none has more than ``cell_rows`` rows. A feature struct
    starts with its time, so the greatest up to a row is the latest, and of
    several at one time the greatest.
    """
    require_columns(spine, [entity, spine_ts], "as-of spine")
    f = [f"_f{i}" for i in range(len(sources))]
    line = spine.select(
        entity, cell_of(spine_ts, cell_seconds).alias(CELL), micros(spine_ts).alias("_at"), F.lit(1).alias("_side"), F.struct(*spine.columns).alias("_s")
    )
    for name, source in zip(f, sources, strict=True):
        require_columns(source.rows, [entity, source.ts, *source.columns], f"as-of source {source.name}")
        value = F.struct(micros(source.ts).alias("at"), F.col(source.ts).alias("ts"), F.struct(*source.columns).alias("v"))
        known = source.rows.where(F.col(entity).isNotNull() & F.col(source.ts).isNotNull())
        known = known.select(entity, cell_of(source.ts, cell_seconds).alias(CELL), micros(source.ts).alias("_at"), F.lit(0).alias("_side"), value.alias(name))
        line = line.unionByName(known, allowMissingColumns=True)
    order = ["_at", "_side"]
    if whole and line.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_rows).isEmpty():
        upto = Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        matched = line.select("_at", "_side", "_s", *[F.max(c).over(upto).alias(c) for c in f]).where("_side = 1")
    else:
        line, timeline = summarised(line, entity, F.col("_at"), [F.max(c).alias(c) for c in f], cell_rows)
        earlier = Window.partitionBy(entity).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
        carried = timeline.select(entity, CELL, *[F.max(c).over(earlier).alias(f"{c}_far") for c in f])
        inside = Window.partitionBy(entity, CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        matched = line.select(entity, CELL, "_at", "_side", "_s", *[F.max(c).over(inside).alias(f"{c}_near") for c in f])
        matched = matched.where("_side = 1").join(carried, [entity, CELL], "left")
        matched = matched.withColumns({c: F.coalesce(f"{c}_near", f"{c}_far") for c in f})
    out = []
    for name, source in zip(f, sources, strict=True):
        if source.ttl_seconds is not None:
            matched = matched.withColumn(name, F.when(F.col(name)["at"] >= F.col("_at") - source.ttl_seconds * 1_000_000, F.col(name)))
        out += [F.col(f"{name}.ts").alias(named(source.name, "")), *[F.col(f"{name}.v.{c}").alias(named(source.name, c)) for c in source.columns]]
    return matched.select("_s.*", *out)


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    entity: str,
    spine_ts: str,
    feature_ts: str,
    columns: Sequence[str],
    ttl_seconds: int | None = None,
    cell_seconds: int = DAY,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Each spine row with the entity's latest feature row at or before its time, as ``feature_ts`` and ``columns``.

    A feature older than the TTL gives nulls.
    """
    source = Source("", features, feature_ts, tuple(columns), ttl_seconds)
    return _joined(spine, [source], entity, spine_ts, cell_seconds, cell_rows, lambda source, column: column or "feature_ts")


def latest_features(features: DataFrame, entity: str, feature_ts: str, ids: DataFrame | None = None) -> DataFrame:
    """Newest feature row per entity, optionally only for the given ids."""
    rows = features if ids is None else features.join(ids.select(entity).distinct(), entity, "left_semi")
    return latest_per_key(rows, [entity], [feature_ts])
