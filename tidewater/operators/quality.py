"""Declarative data-quality suites: one scan for all rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityGateError(RuntimeError):
    """A suite failed on a layer whose failures stop the build."""


@dataclass(frozen=True)
class Rule:
    """One expectation. ``kind`` is one of exists, not_null, unique, in_set, between, regex, row_count."""

    kind: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})" if self.column else self.kind


def exists(column: str) -> Rule:
    return Rule("exists", column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def unique(column: str, where: str | None = None) -> Rule:
    return Rule("unique", column, where=where)


def in_set(column: str, values: Sequence[Any]) -> Rule:
    return Rule("in_set", column, {"values": tuple(values)})


def between(column: str, low: float | None = None, high: float | None = None, strict_low: bool = False, strict_high: bool = False) -> Rule:
    return Rule("between", column, {"low": low, "high": high, "strict_low": strict_low, "strict_high": strict_high})


def regex(column: str, pattern: str) -> Rule:
    return Rule("regex", column, {"pattern": pattern})


def row_count(low: int | None = None, high: int | None = None) -> Rule:
    return Rule("row_count", None, {"low": low, "high": high})


def violation(rule: Rule) -> Column:
    """True on a row that breaks a row rule; nulls break only ``not_null``."""
    c = F.col(rule.column)
    a = rule.args
    if rule.kind == "not_null":
        bad = c.isNull()
    elif rule.kind == "in_set":
        bad = ~c.isin(*a["values"])
    elif rule.kind == "between":
        checks = []
        if a["low"] is not None:
            checks.append(c <= a["low"] if a["strict_low"] else c < a["low"])
        if a["high"] is not None:
            checks.append(c >= a["high"] if a["strict_high"] else c > a["high"])
        bad = reduce(lambda x, y: x | y, checks) if checks else F.lit(False)
    elif rule.kind == "regex":
        bad = ~c.cast("string").rlike(a["pattern"])
    else:
        raise ValueError(f"{rule.kind} is not a row rule")
    bad = F.coalesce(bad, F.lit(False))
    return bad & F.expr(rule.where) if rule.where else bad


ROW_RULES = ("not_null", "in_set", "between", "regex")


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, passed, failing, total) per rule, from one scan of the rows.

    A row becomes one entry with its broken row rules and one entry per
    uniqueness rule with its value. The entries are counted by (rule, value) in
    one aggregation, which all rules share and which combines before the
    shuffle; a second one adds the groups up to a single row.
    """
    lines: list[tuple[Rule, Column, Column]] = []
    flags: dict[str, Column] = {}
    values: dict[int, Column] = {}
    everything = F.col("n")
    for i, rule in enumerate(rules):
        if rule.kind in ROW_RULES and rule.column in df.columns:
            flags[f"f{i}"] = violation(rule).cast("long")
            lines.append((rule, F.col(f"f{i}"), everything))
        elif rule.kind in ROW_RULES or rule.kind == "exists":
            lines.append((rule, F.lit(0 if rule.column in df.columns else 1).cast("long"), everything))
        elif rule.kind == "row_count":
            low, high = rule.args["low"], rule.args["high"]
            bad = F.lit(False)
            bad = bad | (F.col("n") < low) if low is not None else bad
            bad = bad | (F.col("n") > high) if high is not None else bad
            lines.append((rule, bad.cast("long"), everything))
        elif rule.kind == "unique":
            value = F.struct(F.lit(i).alias("rule"), F.col(rule.column).cast("string").alias("value"))
            values[i] = F.when(F.expr(rule.where), value) if rule.where else value
            lines.append((rule, F.col(f"r{i}"), F.col(f"t{i}")))
        else:
            raise ValueError(f"unknown rule kind {rule.kind}")
    own = F.struct(F.lit(-1).alias("rule"), F.lit(None).cast("string").alias("value"))
    checked = df.select(F.explode(F.array_compact(F.array(own, *values.values()))).alias("e"), *[c.alias(f) for f, c in flags.items()])
    is_row = F.col("rule") == -1
    per_value = checked.select("e.*", *flags).groupBy("rule", "value").agg(
        F.count(F.lit(1)).alias("c"), *[F.sum(F.when(is_row, F.col(f))).alias(f) for f in flags]
    )

    def added(condition: Column, what: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(what))), F.lit(0))

    repeated = F.col("value").isNotNull() & (F.col("c") > 1)
    summed = per_value.agg(
        added(is_row, "c").alias("n"),
        *[added(is_row, f).alias(f) for f in flags],
        *[added((F.col("rule") == i) & repeated, "c").alias(f"r{i}") for i in values],
        *[added(F.col("rule") == i, "c").alias(f"t{i}") for i in values],
    )
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"), failing.alias("failing"), total.alias("total")) for r, failing, total in lines])
    return summed.select(F.inline(entries)).select("rule", (F.col("failing") == 0).alias("passed"), "failing", "total")


def success_rate(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if("passed").alias("passed"),
        F.avg(F.col("passed").cast("double")).alias("success_rate"),
    )


def gate(results: DataFrame, layer: str) -> list[str]:
    """Names of failed rules; raises for silver and gold, where bronze only reports.

    Collects at most one row per rule.
    """
    failed = [r["rule"] for r in results.where(~F.col("passed")).select("rule").collect()]
    if failed and layer in ("silver", "gold"):
        raise QualityGateError(f"{layer}: {', '.join(sorted(failed))}")
    return failed


def tag_failures(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rules") -> DataFrame:
    """Adds the list of broken row rules."""
    hits = [F.when(violation(r), F.lit(r.name)) for r in rules if r.kind in ROW_RULES]
    return df.withColumn(name, F.array_compact(F.array(*hits)))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their broken rules)."""
    tagged = tag_failures(df, rules)
    return tagged.where(F.size("failed_rules") == 0).drop("failed_rules"), tagged.where(F.size("failed_rules") > 0)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-null key is missing in the dimension."""
    keys = dim.select(F.col(dim_key).alias("_k"))
    return fact.where(F.col(fact_key).isNotNull()).join(keys, F.col(fact_key) == F.col("_k"), "left_anti")


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, rows, null_rate) in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(names)])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls"), F.col("_n").alias("rows")) for i, c in enumerate(names)]
    )
    return counted.select(F.inline(entries)).withColumn(
        "null_rate", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(F.lit(0.0))
    )


def schema_drift(declared: T.StructType, observed: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, declared type, observed type) for each difference."""
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    have = {f.name: f.dataType.simpleString() for f in observed.fields}
    out = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    out += [(c, "added", None, t) for c, t in have.items() if c not in want]
    out += [(c, "retyped", t, have[c]) for c, t in want.items() if c in have and have[c] != t]
    return sorted(out)


def payload_drift(df: DataFrame, json_col: str, declared: Sequence[str]) -> DataFrame:
    """Keys seen in a JSON column against the declared ones: rows per key and change."""
    seen = (
        df.select(F.explode(F.json_object_keys(json_col)).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    wanted = df.sparkSession.createDataFrame([(d,) for d in declared], "declared string")
    joined = seen.join(wanted, F.col("field") == F.col("declared"), "full_outer")
    change = F.when(F.col("declared").isNull(), "added").when(F.col("field").isNull(), "missing").otherwise("declared")
    return joined.select(
        F.coalesce("field", "declared").alias("field"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        change.alias("change"),
    )


# The suites of the bronze, silver and gold layers.
EMAIL = r"^[^@]+@[^@]+\.[^@]+$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ORDER_STATUSES = ("pending", "processing", "completed", "cancelled", "refunded")

BRONZE_USERS = (
    exists("record_key"),
    exists("raw_json"),
    exists("cdc_op"),
    not_null("cdc_op"),
    in_set("cdc_op", ("c", "u", "d", "r")),
    not_null("kafka_timestamp"),
    not_null("event_date"),
    row_count(low=1),
    regex("event_date", ISO_DATE),
)
SILVER_USERS = (
    exists("user_id"),
    not_null("user_id"),
    unique("user_id", where="is_current = true"),
    not_null("email"),
    regex("email", EMAIL),
    not_null("is_current"),
    in_set("status", ("active", "inactive", "blocked", "unknown")),
    not_null("valid_from"),
    not_null("row_hash"),
    not_null("created_at"),
)
SILVER_ORDERS = (
    not_null("order_id"),
    unique("order_id"),
    not_null("user_id"),
    not_null("status"),
    in_set("status", ORDER_STATUSES),
    not_null("total_amount"),
    between("total_amount", low=0, strict_low=True),
    not_null("created_at"),
)
GOLD_FACT_ORDERS = (
    not_null("order_sk"),
    unique("order_sk"),
    not_null("order_id"),
    unique("order_id"),
    not_null("user_id"),
    not_null("order_date_sk"),
    between("total_amount", low=0, strict_low=True),
    in_set("status", ORDER_STATUSES),
    row_count(low=1),
)
GOLD_DIM_USERS = (
    not_null("user_sk"),
    unique("user_sk"),
    not_null("user_id"),
    unique("user_id"),
    not_null("email"),
    in_set("gender", ("Feminino", "Masculino", "Não-binário", "Não informado")),
)
GOLD_DIM_PRODUCTS = (
    not_null("product_sk"),
    unique("product_sk"),
    not_null("product_id"),
    unique("product_id"),
    between("price", low=0, strict_low=True),
)
GOLD_DIM_DATE = (
    not_null("date_sk"),
    unique("date_sk"),
    not_null("full_date"),
    unique("full_date"),
    not_null("is_weekend"),
    not_null("is_black_friday"),
)
GOLD_FACT_EVENTS = (
    not_null("event_id"),
    unique("event_id"),
    in_set("event_type", ("clicks", "cart", "search", "purchase", "sessions", "reviews")),
    not_null("event_ts"),
)
GOLD_FACT_SESSIONS = (
    not_null("session_sk"),
    unique("session_sk"),
    not_null("session_id"),
    unique("session_id"),
    not_null("user_id"),
)
