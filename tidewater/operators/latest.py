"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], drop_null_key: bool = False
) -> DataFrame:
    """The row with the greatest ``order`` per key; nulls in ``order`` sort first.

    An aggregate, not a window: each task reduces a hot key to one row before
    the shuffle. The remaining columns break ties, so the result is repeatable.
    ``drop_null_key`` drops rows without the first key by an aggregate; a plain
    filter would be pushed below the parsing that produces the key and parse twice.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = [F.col(o) if isinstance(o, str) else o for o in order]
    named = [o.alias(f"_o{i}") for i, o in enumerate(ordering)]
    best = F.max(F.struct(*named, F.struct(*rest).alias("_row")))
    known = [F.count(keys[0]).alias("_known")] if drop_null_key else []
    out = df.groupBy(*keys).agg(best.alias("_best"), *known)
    if drop_null_key:
        out = out.where("_known > 0")
    return out.select(*keys, "_best._row.*").select(*df.columns)


def require_columns(df: DataFrame, cols: Sequence[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {', '.join(missing)}")
