"""Cleaned sources.  Only the columns asked for are read and computed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions import dates, text
from weekloom.operators.ads import ad_day_totals
from weekloom.sources.tables import Source

# Cleaned column of website_sales -> source columns it is made of.
SALES_INPUTS = {
    "order_ts": ("orderdate",),
    "Week": ("orderdate",),
    "_source": ("websource",),
    "cleaned_websource": ("websource",),
    "promo_clean": ("promotion", "promotionid"),
    "strategy_base": ("pricingstrategy",),
    "is_test": ("pricingstrategy",),
}


#: Keys that take a chain of rules, the cheaper column they are made from, and the rules.
LATE = {"cleaned_websource": ("_source", text.label_source)}


def website_sales(source: Source, columns: Iterable[str]) -> DataFrame:
    """Orders with their week, unified traffic source, campaign and promotion."""
    wanted = list(dict.fromkeys(columns))
    inputs = dict.fromkeys(i for c in wanted for i in SALES_INPUTS.get(c, (c,)))
    sales = source("website_sales", list(inputs))
    made = {}
    if "orderdate" in inputs:
        made["order_ts"] = dates.parse_day("orderdate")
    if "websource" in inputs:
        made["_source"] = text.source_text("websource")
    sales = sales.withColumns(made) if made else sales
    known = {
        "Week": lambda: dates.week_start("order_ts"),
        "cleaned_websource": lambda: text.label_source("_source"),
        "campaign": lambda: text.clean_campaign("campaign"),
        "promo_clean": lambda: text.promo_label("promotion", "promotionid"),
        "strategy_base": lambda: text.strategy_base("pricingstrategy"),
        "is_test": lambda: text.is_test("pricingstrategy"),
    }
    return sales.select(*(known[c]().alias(c) if c in known else F.col(c) for c in wanted))


def ga_sessions(source: Source, columns: Iterable[str], anchor: str = "TUE") -> DataFrame:
    """Sessions with their week.  Weeks start on Tuesday unless ``anchor`` says otherwise."""
    inputs = ["date", *(c for c in dict.fromkeys(columns) if c != "Week")]
    sessions = source("ga_sessions_revenue", inputs)
    if "landing_page" in inputs:
        sessions = sessions.fillna({"landing_page": text.UNSPECIFIED})
    day = dates.parse_day("date", dates.US_DAY)
    return sessions.withColumn("Week", dates.week_start(day, anchor))


def with_cost(stats: DataFrame) -> DataFrame:
    """Ad statistics with ``cost``, taken from millionths where there is no such column."""
    if "cost" in stats.columns:
        return stats
    kind = stats.schema["cost_micros"].dataType
    if isinstance(kind, T.IntegralType):
        units = F.col("cost_micros").cast("decimal(20,0)") * F.expr("0.000001BD")
    else:
        units = F.col("cost_micros") / F.lit(1_000_000)
    return stats.withColumn("cost", units).drop("cost_micros")


def google_ads(source: Source, columns: Iterable[str], anchor: str = "TUE") -> DataFrame:
    """Ad statistics with cost and week.  Weeks start on Tuesday unless ``anchor`` says so."""
    stats = with_cost(source("google_ads_stats", None))
    week = dates.week_start(dates.parse_day("date"), anchor)
    return stats.withColumn("Week", week).select(*dict.fromkeys(columns))


def bing_ads(source: Source, columns: Iterable[str]) -> DataFrame:
    """Ad statistics with cost and week; an unreadable date gives no week."""
    stats = source("bing_ads_stats", None).withColumnRenamed("spend", "cost")
    week = dates.week_start(dates.parse_day("date", strict=False))
    return stats.withColumn("Week", week).select(*dict.fromkeys(columns))


def affiliate_sales(
    source: Source, columns: Iterable[str], keep_time: bool = False
) -> DataFrame:
    """Affiliate orders with their week; an unreadable date gives no week."""
    inputs = ["eventdate", *(c for c in dict.fromkeys(columns) if c != "Week")]
    sales = source("affiliate_sales", inputs)
    week = dates.week_start(dates.parse_moment("eventdate"), keep_time=keep_time)
    return sales.withColumn("Week", week)


def facebook_ads(source: Source, columns: Iterable[str]) -> DataFrame:
    """Sums per ad-day over insights and their purchases, with the week of the day."""
    wanted = list(dict.fromkeys(columns))
    totals = ad_day_totals(
        source("facebook_ads_insights", None),
        source("facebook_ads_actions", None),
        roi="roi_sum" in wanted,
    )
    week = dates.week_start(dates.parse_moment("date"))
    return totals.withColumn("Week", week).select(*wanted)


PREPARED = {
    "website_sales": website_sales,
    "ga_sessions_revenue": ga_sessions,
    "google_ads_stats": google_ads,
    "bing_ads_stats": bing_ads,
    "affiliate_sales": affiliate_sales,
    "facebook_ads": facebook_ads,
}
