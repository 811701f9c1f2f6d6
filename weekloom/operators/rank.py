"""Top rows per group and overall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.measures import Difference, Measure, Ratio
from weekloom.operators.rollup import require, rollup


def best_first(metrics: str | Sequence[str], ties: Sequence[str]) -> list[Column]:
    """Sort order: metrics descending, then ``ties`` ascending, NULLs last everywhere."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    return [F.col(m).desc_nulls_last() for m in metrics] + [
        F.col(t).asc_nulls_last() for t in ties
    ]


def top_n_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    metric: str,
    n: int = 10,
    ties: Sequence[str] = (),
    drop_null_metric: bool = False,
) -> DataFrame:
    """Exactly the ``n`` best rows of each group; groups with a NULL key are left out.

    ``ties`` has to make the order total.  The ``row_number`` limit is applied before the
    shuffle as well, so a task sends at most ``n`` rows per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    kept = require(df, [*group, metric] if drop_null_metric else group)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*best_first(metric, ties)))
    return kept.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def top_k(df: DataFrame, metrics: str | Sequence[str], k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` best rows overall, kept as a heap per task and merged."""
    return df.orderBy(*best_first(metrics, ties)).limit(k)


def top_k_groups(
    df: DataFrame,
    key: str,
    measures: Mapping[str, Measure],
    by: str,
    k: int = 10,
    derived: Mapping[str, Ratio | Difference] | None = None,
) -> DataFrame:
    """Roll up by ``key`` and keep the ``k`` best groups by ``by``."""
    return top_k(rollup(df, [key], measures, derived), by, k, [key])


def keep_top_k(df: DataFrame, key: str, measure: Measure, k: int = 10) -> DataFrame:
    """All rows whose ``key`` is among the ``k`` keys with the largest ``measure``.

    The semi-join's other side has at most ``k`` rows, so it is sent to every task.  Both sides
    read ``df``, which should be a stored table.
    """
    best = top_k_groups(df, key, {"_score": measure}, "_score", k).select(key)
    return df.join(F.broadcast(best), key, "left_semi")
