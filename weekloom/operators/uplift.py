"""Promotion uplift against the weeks' sales without promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.measures import count, distinct, safe_div, total
from weekloom.functions.text import NO_PROMOTION
from weekloom.operators.rank import top_n_per_group
from weekloom.operators.rollup import rollup

PROMO_TOTALS = {
    "total_revenue": total("novusd"),
    "total_profit": total("contributionmargin"),
    "total_orders": count("marketordernumber"),
}
LIFTS = ("revenue", "profit", "orders")


def daily_averages(sales: DataFrame) -> DataFrame:
    """Weekly totals per promotion, its active days and its averages per active day."""
    measures = PROMO_TOTALS | {"days_active": distinct("order_ts")}
    weekly = rollup(sales, ["Week", "promo_clean"], measures, exact=True)
    return weekly.withColumns(
        {
            f"avg_daily_{name}": F.try_divide(
                F.col(f"total_{name}").cast("double"), F.col("days_active").cast("double")
            )
            for name in LIFTS
        }
    )


def promo_uplift(sales: DataFrame, n: int = 10, baseline: str = NO_PROMOTION) -> DataFrame:
    """Percent lift of each week's ``n`` most profitable promotions over the baseline.

    The baseline is one row per week, so ranking it apart keeps it next to the top rows: one
    scan and one ranking give both, and the last window sees at most ``n + 1`` rows per week.
    """
    averages = daily_averages(sales).withColumn("_base", F.col("promo_clean") == baseline)
    kept = top_n_per_group(averages, ["Week", "_base"], "total_profit", n, ["promo_clean"])
    week = Window.partitionBy("Week")
    kept = kept.withColumns(
        {
            f"_base_{name}": F.max(F.when(F.col("_base"), F.col(f"avg_daily_{name}"))).over(week)
            for name in LIFTS
        }
    )
    lifts = [
        safe_div(F.col(f"avg_daily_{name}") - F.col(f"_base_{name}"), f"_base_{name}", 100, None)
        .alias(f"{name}_lift")
        for name in LIFTS
    ]
    return kept.where(~F.col("_base")).select("Week", "promo_clean", *lifts)


def pivot_uplift(
    pivoted: DataFrame, index: Sequence[str] = ("Week",), baseline: str = NO_PROMOTION
) -> DataFrame:
    """Add ``<column>_uplift``, the relative lift over the baseline column, for every column.

    ``pivoted`` has one column per promotion.  The lift is NULL where the baseline is 0.
    """
    if baseline not in pivoted.columns:
        raise ValueError(f"the pivoted table has no baseline column {baseline!r}")
    base = F.col(f"`{baseline}`")
    others = [c for c in pivoted.columns if c not in (*index, baseline)]
    return pivoted.withColumns(
        {f"{c}_uplift": F.when(base != 0, (F.col(f"`{c}`") - base) / base) for c in others}
    )
