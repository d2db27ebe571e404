"""Column expressions shared by the plans. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the public dbt_utils surrogate key rule writes for a null part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Epoch numbers from this size on are microseconds, below it milliseconds.
MICROS_FROM = 100_000_000_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str) -> Column:
    """Timestamp from ISO text, epoch milliseconds or epoch microseconds; else null."""
    text = F.trim(_col(c).cast("string"))
    number = F.when(text.rlike(r"^-?\d{9,18}$"), text.try_cast("bigint"))
    micros = F.when(F.abs(number) >= MICROS_FROM, number).otherwise(number * 1000)
    return F.coalesce(F.timestamp_micros(micros), F.when(number.isNull(), F.try_to_timestamp(text)))


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols: Column | str) -> Column:
    """MD5 over business columns; null and empty text hash differently."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\x00")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *parts))


def date_key(ts: Column | str) -> Column:
    """yyyymmdd as an integer, by arithmetic so that no text is formatted."""
    c = _col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def complete_units(unit_seconds: int, start: Column | str, end: Column | str) -> Column:
    """Whole units of time between two instants, cut toward zero."""
    span = micros(end) - micros(start)
    return (span - span % (unit_seconds * 1_000_000)) / (unit_seconds * 1_000_000)


def complete_minutes(start: Column | str, end: Column | str) -> Column:
    return complete_units(60, start, end).cast("long")


def complete_seconds(start: Column | str, end: Column | str) -> Column:
    return complete_units(1, start, end).cast("long")


def fractional_days(start: Column | str, end: Column | str) -> Column:
    """Days between two instants as a double, at whole-second resolution."""
    seconds = F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))
    return seconds / F.lit(86400.0)


def guarded_ratio(num: Column | str, den: Column | str, default: float | Column = 0.0) -> Column:
    """``num / den`` where the denominator is positive, else the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(_col(den) > 0, _col(num) / _col(den)).otherwise(fallback)


def label_map(c: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    out = None
    for key, label in mapping.items():
        hit = _col(c) == F.lit(key)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    out = None
    for condition, label in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return F.lit(default) if out is None else out.otherwise(default)


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge with ``value <= edge``; one more label than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bucketize needs one more label than edges")
    rules = [(_col(c) <= F.lit(edge), label) for edge, label in zip(edges, labels)]
    return first_match(rules, labels[-1])


def risk_band(p: Column | str, high: float = 0.7, medium: float = 0.4) -> Column:
    return first_match([(_col(p) >= high, "high"), (_col(p) >= medium, "medium")], "low")


def one_hot(c: Column | str, values: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per listed value, compared in lower case."""
    lowered = F.lower(_col(c))
    return [F.coalesce((lowered == v).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in values]


def last_items(seq: Column | str, n: int) -> Column:
    """The last ``n`` entries of an array, or all of them when it is shorter."""
    c = _col(seq)
    return F.when(F.size(c) > n, F.slice(c, -n, n)).otherwise(c)


def pad_right(seq: Column | str, length: int, fill: int = 0) -> Column:
    c = _col(seq)
    gap = F.greatest(F.lit(length) - F.size(c), F.lit(0))
    element = F.array_repeat(F.lit(fill).cast("long"), gap)
    return F.concat(c.cast("array<long>"), element)


def session_sample(seq: Column | str, max_len: int) -> Column:
    """(padded input, target, input length) of one item sequence of two or more items."""
    tail = last_items(seq, max_len)
    head = F.slice(tail, F.lit(1), F.size(tail) - 1)
    return F.struct(
        pad_right(head, max_len).alias("input"),
        F.element_at(tail, -1).alias("target"),
        F.size(head).alias("length"),
    )


def last_days(c: Column | str, days: int, as_of: Column) -> Column:
    """Predicate: date on or after ``as_of`` minus ``days``."""
    return F.to_date(_col(c)) >= F.date_sub(F.to_date(as_of), days)
