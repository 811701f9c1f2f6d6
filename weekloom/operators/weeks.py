"""Week ranges, change from week to week, and loading of stored weekly tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.dates import read_week

# Days back from the latest week; None is the whole history.
PRESETS: dict[str, int | None] = {
    "Last 7 Days": 7,
    "Last 28 Days": 28,
    "Last 90 Days": 90,
    "Last 365 Days": 365,
    "Lifetime": None,
}


def normalise_week(df: DataFrame, column: str = "Week") -> DataFrame:
    """Turn a stored week, plain or as a ``first/last`` label, into a timestamp."""
    return df.withColumn(column, read_week(column)) if column in df.columns else df


def filter_weeks(
    df: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    column: str = "Week",
) -> DataFrame:
    """Rows with ``start <= Week <= end``; a table without the column passes unchanged."""
    if column not in df.columns:
        return df
    return df.where(F.col(column).between(_day(start), _day(end)))


def preset_range(
    df: DataFrame, anchor: DataFrame, preset: str | int | None, column: str = "Week"
) -> DataFrame:
    """Rows in the last days before the latest week of ``anchor``, both ends included.

    ``preset`` is a label of :data:`PRESETS` or a number of days.  The bounds are scalar
    subqueries, so nothing runs on the driver and no join is needed.
    """
    days = PRESETS[preset] if isinstance(preset, str) else preset
    last = anchor.agg(F.max(column)).scalar()
    first = anchor.agg(F.min(column)).scalar() if days is None else F.date_sub(last, days)
    return filter_weeks(df, first, last, column)


def week_over_week(
    df: DataFrame, metric: str, previous: str, change: str, order: str = "Week"
) -> DataFrame:
    """Add the preceding row's ``metric`` and the change from it, in week order.

    Meant for a series with one row per week: the window has a single partition, whose size
    the calendar bounds.
    """
    before = F.lag(metric, 1).over(Window.orderBy(order))
    return df.withColumn(previous, before).withColumn(change, F.col(metric) - F.col(previous))


def latest_change(
    df: DataFrame,
    metric: str,
    previous: str,
    change: str,
    order: str = "Week",
    zero_when_unknown: bool = False,
) -> DataFrame:
    """The latest week with its change from the week before, absolute and in percent.

    The percentage is 0 after a zero.  Without a week before, change and percentage are NULL,
    or 0 with ``zero_when_unknown``.  Only the last two rows reach the window.
    """
    last_two = df.orderBy(F.col(order).desc_nulls_last()).limit(2)
    latest = (
        week_over_week(last_two, metric, previous, change, order)
        .orderBy(F.col(order).desc_nulls_last())
        .limit(1)
    )
    prev = F.col(previous)
    pct = F.when(prev == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col(change), prev) * F.lit(100)
    )
    diff = F.col(change)
    if zero_when_unknown:
        diff = F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(diff)
        pct = F.coalesce(pct, F.lit(0.0))
    return latest.withColumns({"diff": diff, "pct": pct})


def _day(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")
