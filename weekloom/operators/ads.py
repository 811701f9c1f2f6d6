"""Joining ad insights with the purchases they led to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.measures import count, total
from weekloom.operators.exact import grouped
from weekloom.operators.rollup import quoted

# The action types that count as a purchase.
PURCHASE_ACTIONS = (
    "purchase",
    "omni_purchase",
    "onsite_web_purchase",
    "offsite_conversion.fb_pixel_purchase",
    "onsite_web_app_purchase",
    "web_in_store_purchase",
)
AD_DAY = ("date", "campaign_id", "adset_id", "ad_id")
#: One in so many rows is what a task may get of one ad-day.
SHARE = 1_000


def purchase_actions(
    actions: DataFrame, types: Sequence[str] = PURCHASE_ACTIONS
) -> DataFrame:
    """Actions of the given types only."""
    return actions.where(F.col("action_type").isin(*types))


def _keyed(df: DataFrame) -> DataFrame:
    """Make the ad-day columns text with NULL as ``None``, so that missing ids match."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in AD_DAY}
    )


def row_roi(value: Column | str, spend: Column | str) -> Column:
    """``value / spend``, and 0 where it is undefined."""
    value = F.col(value) if isinstance(value, str) else value
    spend = F.col(spend) if isinstance(spend, str) else spend
    return F.coalesce(F.try_divide(value.cast("double"), spend.cast("double")), F.lit(0.0))


def join_ad_actions(
    insights: DataFrame,
    actions: DataFrame,
    types: Sequence[str] = PURCHASE_ACTIONS,
    fanout: bool = True,
) -> DataFrame:
    """Insights with the value of their purchases, matched by day, campaign, ad set and ad.

    With ``fanout`` an insight with several purchases gives one row for each, so that its
    spend repeats.  Otherwise purchases are summed first and every insight stays one row.

    An ad-day that holds more than two in SHARE of all insights, of which there are less than SHARE, is
    cut into parts of at most one in SHARE by a hash of the row, and its purchases go to each part.
    """
    right = _keyed(purchase_actions(actions, types))
    if fanout:
        right = right.select(*AD_DAY, "action_type", "value")
    else:
        right = grouped(right, AD_DAY, {"value": total("value")})
    left = _keyed(insights)
    busy = F.broadcast(_busy(left))
    spot = F.pmod(F.xxhash64(*map(quoted, insights.columns)), F.coalesce("_parts", F.lit(1))).cast("int")
    left = left.join(busy, list(AD_DAY), "left").withColumn("_part", spot).drop("_parts")
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    right = right.join(busy, list(AD_DAY), "left").withColumn("_part", F.explode(every)).drop("_parts")
    joined = left.join(right, [*AD_DAY, "_part"], "left").drop("_part")
    return joined.withColumn("ROI", row_roi("value", "spend"))


def _busy(rows: DataFrame, share: int = SHARE) -> DataFrame:
    """Ad-days with at least two in ``share`` of all rows, fewer than ``share``, and how many parts to cut them into."""
    whole = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(*AD_DAY).agg((F.count(F.lit(1)) * share).alias("_n"))
    parts = F.ceil(F.col("_n") / whole).cast("int").alias("_parts")
    return counts.where(F.col("_n") >= 2 * whole).select(*AD_DAY, parts)


def ad_day_totals(
    insights: DataFrame,
    actions: DataFrame,
    types: Sequence[str] = PURCHASE_ACTIONS,
    roi: bool = True,
) -> DataFrame:
    """Sums over the fanned-out join per ad-day and campaign name, without fanning out.

    Each side shrinks to one row per ad-day before they meet.  An insight counts once per
    purchase and a purchase once per insight, so the sums of one side are multiplied by the
    row count of the other.  A busy ad-day, or all rows without ids, is therefore one row of
    the join and not a product of two lists.

    Columns: the ad-day, campaign_name, revenue, cost, impressions, clicks, and roi_sum and
    rows, whose quotient is the average of the row-level ROI.  Without ``roi``, roi_sum is left out
    and spares the exact sum of quotients.
    """
    shown = _keyed(insights).withColumn("_one", F.lit(1))
    totals = {f"_{c}": total(c) for c in ("spend", "impressions", "clicks")}
    totals["_insights"] = count("_one")
    if roi:
        spend = F.col("spend").cast("double")
        shown = shown.withColumn("_per_spend", F.try_divide(F.lit(1.0), spend))
        totals["_per_spend"] = total("_per_spend")
    spent = grouped(shown, [*AD_DAY, "campaign_name"], totals)
    acted = _keyed(purchase_actions(actions, types)).withColumn("_one", F.lit(1))
    bought = grouped(acted, AD_DAY, {"_actions": count("_one"), "_value": total("value")})
    times = F.coalesce(F.col("_actions"), F.lit(1).cast("bigint"))
    value = F.col("_value")
    quotients = []
    if roi:
        each = F.coalesce(value.cast("double") * F.col("_per_spend"), F.lit(0.0))
        quotients = [each.alias("roi_sum")]
    return spent.join(bought, list(AD_DAY), "left").select(
        *AD_DAY,
        "campaign_name",
        (value * F.col("_insights")).alias("revenue"),
        (F.col("_spend") * times).alias("cost"),
        (F.col("_impressions") * times).alias("impressions"),
        (F.col("_clicks") * times).alias("clicks"),
        *quotients,
        (F.col("_insights") * times).alias("rows"),
    )
