"""Forecasts of a daily or weekly series, for one series or many.

All rows of one day are first reduced to their count, sum and sum of squares, which is all a
least-squares fit needs.  What is then held per series is bounded by the days of the calendar,
however many rows the series has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.rollup import require

# The fit travels with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the additive model: possible changes of slope, the part of the history they
# lie in, how much they may vary, and the waves per year and per week.
CHANGEPOINTS = 25
CHANGE_SPAN = 0.8
CHANGE_SCALE = 0.05
WAVE_SCALE = 10.0
YEARLY_WAVES = 10
WEEKLY_WAVES = 3
YEAR_DAYS = 365.25


def forecast_trend(
    df: DataFrame,
    y: str,
    horizon: int,
    ts: str = "Week",
    series: Sequence[str] = (),
    interval: float = 0.8,
) -> DataFrame:
    """Straight line through the history, with each day of it and ``horizon`` days after it.

    Columns: the series, ds, yhat, yhat_lower, yhat_upper.
    """
    if horizon < 1:
        raise ValueError("the horizon is at least one day")
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    day = F.unix_date(F.col("_ds")).cast("double")
    value = F.col(y).cast("double")
    rows = require(df, [ts, y]).withColumn("_ds", F.col(ts).cast("date"))
    fit = rows.groupBy(*series).agg(
        F.coalesce(F.regr_slope(value, day), F.lit(0.0)).alias("_slope"),
        F.avg(value).alias("_mean_y"),
        F.avg(day).alias("_mean_t"),
        F.regr_syy(value, day).alias("_syy"),
        F.regr_sxy(value, day).alias("_sxy"),
        F.count(value).alias("_n"),
        F.max("_ds").alias("_last"),
        F.collect_set("_ds").alias("_days"),
    )
    left_over = F.greatest(F.col("_syy") - F.col("_slope") * F.col("_sxy"), F.lit(0.0))
    spread = F.when(F.col("_n") > 2, F.sqrt(left_over / (F.col("_n") - 2))).otherwise(0.0)
    future = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))
    line = F.col("_mean_y") + F.col("_slope") * (
        F.unix_date("ds").cast("double") - F.col("_mean_t")
    )
    out = (
        fit.where(F.col("_n") > 0)
        .withColumn("_spread", spread * F.lit(z))
        .withColumn("ds", F.explode(F.concat("_days", future)))
        .withColumn("yhat", line)
    )
    return out.select(
        *series,
        "ds",
        "yhat",
        (F.col("yhat") - F.col("_spread")).alias("yhat_lower"),
        (F.col("yhat") + F.col("_spread")).alias("yhat_upper"),
    )


def forecast(
    df: DataFrame,
    y: str,
    horizon: int,
    ts: str = "Week",
    series: Sequence[str] = (),
    interval: float = 0.8,
    components: bool = False,
) -> DataFrame:
    """Additive forecast: a line that may bend, plus yearly and weekly waves.

    Yearly waves are fitted from two years of history on, weekly ones where days lie less than
    a week apart.  Columns: the series, ds, yhat, yhat_lower, yhat_upper; with ``components``
    the parts trend, yearly and weekly too.
    """
    if horizon < 1:
        raise ValueError("the horizon is at least one day")
    keys = list(series) or ["_series"]
    value = F.col(y).cast("double")
    rows = require(df, [ts, y]).withColumn("_ds", F.col(ts).cast("date"))
    if not series:
        rows = rows.withColumn("_series", F.lit(0))
    daily = rows.groupBy(*keys, "_ds").agg(
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.sum(value * value).alias("_squares"),
    )
    numbers = ["yhat", "yhat_lower", "yhat_upper", "trend", "yearly", "weekly"]
    fields = [f"`{k}` {daily.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*fields, "ds date", *(f"{n} double" for n in numbers)])

    def one_series(key: tuple, days: pd.DataFrame) -> pd.DataFrame:
        out = _fit(days.sort_values("_ds"), horizon, interval)
        for name, part in zip(keys, key, strict=True):
            out[name] = part
        return out[[*keys, "ds", *numbers]]

    out = daily.groupBy(*keys).applyInPandas(one_series, schema)
    return out.select(*series, "ds", *(numbers if components else numbers[:3]))


def _fit(days: pd.DataFrame, horizon: int, interval: float) -> pd.DataFrame:
    """Fit one series and evaluate it on its own days and the days after them."""
    day = pd.to_datetime(days["_ds"]).to_numpy("datetime64[D]").astype("int64")
    n = days["_n"].to_numpy(float)
    mean = days["_sum"].to_numpy(float) / n
    grid = np.concatenate([day, day[-1] + np.arange(1, horizon + 1)])
    start, span = day[0], max(day[-1] - day[0], 1)
    scale = np.abs(mean).max() or 1.0
    spacing = np.diff(day).min() if len(day) > 1 else 7
    blocks = {"trend": _trend(len(day))}
    if span >= 2 * YEAR_DAYS:
        blocks["yearly"] = _waves(YEAR_DAYS, YEARLY_WAVES)
    if spacing < 7 and span >= 14:
        blocks["weekly"] = _waves(7, WEEKLY_WAVES)

    def design(at: np.ndarray) -> dict[str, np.ndarray]:
        return {name: make(at, (at - start) / span) for name, make in blocks.items()}

    known = design(day)
    x, target = np.hstack(list(known.values())), mean / scale
    bends = known["trend"].shape[1] - 2
    free = np.zeros(x.shape[1])
    free[2 : 2 + bends] = CHANGE_SCALE**-2
    free[2 + bends :] = WAVE_SCALE**-2
    line = _solve(x[:, :2], target, n, np.zeros(2))
    noise = np.average((target - x[:, :2] @ line) ** 2, weights=n)
    beta = _solve(x, target, n, free * max(noise, 1e-9))

    within = (days["_squares"].to_numpy(float) - n * mean**2).clip(min=0).sum() / scale**2
    sigma2 = (np.sum(n * (target - x @ beta) ** 2) + within) / n.sum()
    ahead = np.clip((grid - start) / span - 1, 0, None)
    bend = np.abs(beta[2 : 2 + bends]).mean() if bends else 0.0
    drift = 2 * bends * bend**2 * ahead**3 / 3
    half = NormalDist().inv_cdf(0.5 + interval / 2) * np.sqrt(sigma2 + drift) * scale

    parts, at = {"yearly": 0.0, "weekly": 0.0}, 0
    for name, block in design(grid).items():
        parts[name] = block @ beta[at : at + block.shape[1]] * scale
        at += block.shape[1]
    yhat = parts["trend"] + parts["yearly"] + parts["weekly"]
    dates = grid.astype("datetime64[D]").astype("datetime64[s]")
    frame = {"ds": pd.Series(dates).dt.date, "yhat": yhat}
    frame |= {"yhat_lower": yhat - half, "yhat_upper": yhat + half}
    return pd.DataFrame(frame | parts)


def _trend(points: int):
    bends = min(CHANGEPOINTS, max(int(points * CHANGE_SPAN) - 1, 0))
    at = np.linspace(0, CHANGE_SPAN, bends + 1)[1:]

    def columns(_day: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones_like(t), t, *(np.clip(t - s, 0, None) for s in at)])

    return columns


def _waves(period: float, count: int):
    def columns(day: np.ndarray, _t: np.ndarray) -> np.ndarray:
        turns: Iterable[np.ndarray] = (2 * np.pi * k * day / period for k in range(1, count + 1))
        return np.column_stack([f(turn) for turn in turns for f in (np.sin, np.cos)])

    return columns


def _solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Weighted least squares with a penalty per column; the smallest solution if not unique."""
    normal = (x * weight[:, None]).T @ x + np.diag(ridge)
    return np.linalg.lstsq(normal, (x * weight[:, None]).T @ y, rcond=1e-13)[0]
