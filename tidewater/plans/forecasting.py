"""Daily demand forecasts and their evaluation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.evaluation import forecast_errors


def _timeline(series: Sequence[str], date: str):
    return Window.partitionBy(*(series or [F.lit(0)])).orderBy(date)


def naive_fit(df: DataFrame, value: str, date: str = "ds", lag: int = 7, series: Sequence[str] = ()) -> DataFrame:
    """Each day's value with the value ``lag`` days before as its prediction; one row per day and series."""
    return df.withColumn("predicted", F.lag(value, lag).over(_timeline(series, date))).where(F.col("predicted").isNotNull())


def seasonal_naive(df: DataFrame, value: str, horizon: int, date: str = "ds", season: int = 7, series: Sequence[str] = ()) -> DataFrame:
    """Forecast of ``horizon`` days: the value of the same position in the last season.

    A season longer than the series repeats what there is.
    """
    keys = list(series) or [F.lit("all").alias("series")]
    names = list(series) or ["series"]
    back = Window.partitionBy(*names).orderBy(F.col(date).desc())
    tail = df.select(*keys, date, value).withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= season)
    last = tail.groupBy(*names).agg(
        F.max(date).alias("_end"),
        F.transform(F.array_sort(F.collect_list(F.struct(date, value))), lambda x: x[value]).alias("_season"),
    )
    steps = last.select(*names, "_end", "_season", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_day"))
    position = (F.col("horizon_day") - 1) % F.size("_season") + 1
    return steps.select(
        *names,
        F.date_add("_end", F.col("horizon_day")).alias(date),
        "horizon_day",
        F.greatest(F.element_at("_season", position.cast("int")), F.lit(0.0)).alias("predicted"),
    )


def with_history(history: DataFrame, forecast: DataFrame, date: str, value: str, predicted: str = "predicted") -> DataFrame:
    """Past values and forecast in one table with a kind flag."""
    past = history.select(date, F.col(value).cast("double").alias("value"), F.lit("history").alias("kind"))
    ahead = forecast.select(date, F.col(predicted).cast("double").alias("value"), F.lit("forecast").alias("kind"))
    return past.unionByName(ahead)


def walk_forward(df: DataFrame, value: str, folds: int, lookback: int, horizon: int, season: int = 7, date: str = "ds") -> DataFrame:
    """Errors of the seasonal naive forecast on the last full window of each fold.

    With n days and fold size n div (folds + 1), fold f covers the days from
    f * size on, size + lookback + horizon long, cut at the end of the series.
    The forecast sees nothing after the window's inputs.
    """
    timeline = Window.orderBy(date)
    numbered = df.select(
        (F.row_number().over(timeline) - 1).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("n"),
        F.col(value).cast("double").alias("actual"),
    )
    size = F.floor(F.col("n") / (folds + 1))
    spread = numbered.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    start = F.col("fold") * size
    end = F.least(start + size + lookback + horizon, F.col("n"))
    inside = spread.withColumns({"_start": start, "_end": end}).where(
        (F.col("i") >= F.col("_start")) & (F.col("i") < F.col("_end")) & (F.col("_end") - F.col("_start") >= lookback + horizon)
    )
    first_target = F.col("_end") - horizon
    step = F.col("i") - first_target
    rows = inside.select("fold", "i", "actual", step.alias("step"))
    targets = rows.where(F.col("step") >= 0).withColumn("source", F.col("step") % season - season)
    inputs = rows.where(F.col("step").between(-season, -1)).select(
        "fold", F.col("step").alias("source"), F.col("actual").alias("predicted")
    )
    return forecast_errors(targets.join(inputs, ["fold", "source"]), "actual", "predicted", ["fold"])


def _fit_and_roll(values: np.ndarray, lags: int, horizon: int) -> np.ndarray:
    """Least squares on the last ``lags`` values, rolled forward and cut at zero."""
    if len(values) <= lags:
        last = values[-1] if len(values) else 0.0
        return np.full(horizon, max(float(last), 0.0))
    x = np.lib.stride_tricks.sliding_window_view(values[:-1], lags)
    design = np.column_stack([np.ones(len(x)), x])
    weights, *_ = np.linalg.lstsq(design, values[lags:], rcond=None)
    recent = list(values[-lags:])
    out = []
    for _ in range(horizon):
        nxt = max(float(weights[0] + np.dot(weights[1:], recent)), 0.0)
        out.append(nxt)
        recent = [*recent[1:], nxt]
    return np.array(out)


def lag_forecast(df: DataFrame, series: str, value: str, horizon: int = 7, lags: int = 7, date: str = "ds") -> DataFrame:
    """Recursive regression forecast per series; a group is one daily series, bounded by the calendar."""

    def forecast(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(date)
        rolled = _fit_and_roll(ordered[value].to_numpy(dtype=float), lags, horizon)
        days = pd.date_range(pd.Timestamp(ordered[date].iloc[-1]) + pd.Timedelta(days=1), periods=horizon)
        return pd.DataFrame(
            {series: key[0], date: days.date, "horizon_day": np.arange(1, horizon + 1, dtype="int32"), "predicted": rolled}
        )

    kind = df.schema[series].dataType.simpleString()
    return (
        df.select(series, date, F.col(value).cast("double").alias(value))
        .groupBy(series)
        .applyInPandas(forecast, f"{series} {kind}, {date} date, horizon_day int, predicted double")
    )

