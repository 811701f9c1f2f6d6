
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from weekloom.functions import dates, text  # noqa: E402
from weekloom.functions import measures as m  # noqa: E402
from weekloom.operators import ads, correlate, distinct, explore, forecast, report, uplift  # noqa: E402
from weekloom.operators import weeks as wk  # noqa: E402
from weekloom.operators.rank import keep_top_k  # noqa: E402
from weekloom.operators.rollup import rollup  # noqa: E402
from weekloom.plans import prepare  # noqa: E402
from weekloom.plans.batch import run_batch  # noqa: E402
from weekloom.plans.tables import ALIASES, DATASETS, OUTPUTS, TABLES, Tables  # noqa: E402
from weekloom.sources.layer import Layer, StoredRange, StoredTables, stamp_of  # noqa: E402
from weekloom.sources.retail import retail_source  # noqa: E402
from weekloom.sources.schemas import SCHEMAS  # noqa: E402
from weekloom.sources.tables import fresh_folder  # noqa: E402

try:  # the subpackage for training data can be left out of an installation
    import corpus_pipeline
    from weekloom.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "weekloom.llm", "weekloom.llm.queries"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
AUTHOR = "red widget"


def entry(spark: SparkSession) -> DataFrame:
    """The ten most profitable campaigns of each week."""
    return Tables(retail_source(spark, SMOKE_DIR))["website_weekly_top_campaign"]


def _round(df: DataFrame, digits: int) -> DataFrame:
    """Doubles to a fixed number of digits: sums of doubles depend on the order of the rows."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals}) if decimals else df


@dataclass(frozen=True)
class Report:
    """A query over weekly tables: computed with all their weeks, or stored and cut by ``cut``."""

    step: Callable[[Tables | StoredRange], DataFrame]
    digits: int | None = None
    cut: Callable[[StoredTables], StoredRange] | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if self.cut:
            out = self.step(self.cut(_stored(spark, sf_dir)))
        else:
            out = self.step(Tables(retail_source(spark, sf_dir)))
        return out if self.digits is None else _round(out, self.digits)


def _on(
    table: str, step: Callable[[DataFrame], DataFrame], digits: int | None = None, cut=None
) -> Report:
    """A query that applies ``step`` to a weekly table."""
    return Report(lambda tables: step(tables[table]), digits, cut)


def _whole(tables: StoredTables) -> StoredTables:
    """All weeks of stored tables: for queries that read a table more than once."""
    return tables


_with = Report  # a query over several weekly tables


_LAYERS: dict[tuple[str, str], Layer] = {}


def _stored(spark: SparkSession, sf_dir: str) -> StoredTables:
    """The session's layer of weekly tables over ``sf_dir``.  A table is written when first asked for.

    Tables made from other files than now lie in ``sf_dir`` are written anew.
    """
    at = spark.sparkContext.applicationId, sf_dir
    if at not in _LAYERS:
        _LAYERS[at] = Layer(spark, fresh_folder(spark, "weekly"))
    stamp = stamp_of(spark, [sf_dir])
    source = retail_source(spark, sf_dir)

    def make(name: str) -> DataFrame:
        if name == ORDER_BITMAPS:
            column = "marketordernumber"
            return distinct.weekly_bitmaps(prepare.affiliate_sales(source, [column]), column)
        return Tables(source)[name]

    return StoredTables(_LAYERS[at], make, stamp, DATASETS | ALIASES)


def _between(first: str, last: str) -> Callable[[StoredTables], StoredRange]:
    return lambda tables: tables.between(first, last)


def _last(preset: str) -> Callable[[StoredTables], StoredRange]:
    return lambda tables: tables.last_days(wk.PRESETS[preset], OVERALL)


def _source(step: Callable[[Callable], DataFrame]) -> Query:
    """A query over source tables."""
    return lambda spark, sf_dir: _plain(step(retail_source(spark, sf_dir)))


def _raw(table: str, step: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over one of the given files."""
    return lambda spark, sf_dir: step(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _sales(*columns: str) -> Query:
    return _source(lambda source: prepare.website_sales(source, columns))


def _preset(table: str, preset: str) -> Query:
    return Report(lambda tables: tables[table], cut=_last(preset))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All output tables written to a shared folder, and the rows in each."""
    layer = run_batch(spark, retail_source(spark, sf_dir), fresh_folder(spark, "batch"))
    counts = None
    for name in layer.current():
        one = layer[name].agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Tables(retail_source(spark, sf_dir))["website_weekly_overall"]
    return Layer(spark, fresh_folder(spark, "sink")).replace("website_weekly_overall", table)


def _normalised(tables: Tables) -> DataFrame:
    return wk.normalise_week(tables["website_pricing_strategy_analysis"])


def _joined(fanout: bool) -> Query:
    return _source(
        lambda source: ads.join_ad_actions(
            source("facebook_ads_insights", None),
            source("facebook_ads_actions", None),
            fanout=fanout,
        )
    )


def _pivot_uplift(tables: Tables) -> DataFrame:
    metrics = tables["promo_weekly_metrics"]
    return uplift.pivot_uplift(explore.pivot(metrics, "Week", "promo_clean", "total_revenue"))


def _monday_sessions(source: Callable) -> DataFrame:
    columns = [measure.column for measure in m.SESSION_TOTALS.values()]
    sessions = prepare.ga_sessions(source, columns, anchor="MON")
    return rollup(sessions, ["Week"], m.SESSION_TOTALS, exact=True)


def _corr(method: str) -> Query:
    return _on(OVERALL, lambda d: correlate.corr(d, MEASURED, method), 6)


def _pivot(how: str, row: str = "campaign", digits: int | None = None) -> Query:
    step = partial(
        explore.pivot, row=row, column="category", value="Total_Revenue", how=how
    )
    return _on("website_campaign_segmentation_analysis", step, digits)


def _week_column(name: str, **options) -> Query:
    return _raw(
        "orders",
        lambda d: d.select("o_orderkey", dates.week_start("o_orderdate", **options).alias(name)),
    )


OVERALL = "website_weekly_overall"
ORDER_BITMAPS = "affiliate_order_bitmaps"
#: Columns compared with each other, the first numeric ones of the table.
MEASURED = ("Total_Revenue", "Total_Profit", "Order_Count", "Total_Shipping", "Total_Discount")
CARDS = (
    "kpi_website", "kpi_website_weighted", "kpi_facebook", "kpi_ga", "kpi_google_ads", "kpi_bing",
    "kpi_affiliate", "profit_by_platform",
)
#: Reports that are registered for the last 90 days too.  Sessions and social ads end years after
#: the orders do, so only their cards are: they show the zeros of a range without data.
RANGED = (
    *CARDS, "affiliate_share", "top10_campaigns_by_revenue", "overall_top_campaigns",
    "websource_top10_trend", "pricing_top10_trend", "promo_global_top10", "promo_uplift_top10",
    "best_strategy_combo", "authors_top10", "author_list", "author_report", "author_trend",
    "bing_top10_period", "affiliate_daily", "affiliate_top10_period", "weekly_trend",
    "weekly_trend_google_ads", "weekly_trend_bing",
)
ROI_DIGITS = {
    "fb_weekly_campaigns": "ROI",
    "facebook_ads_top10_campaigns": "ROI",
    "facebook_ads_weekly_aggregated": "Avg_ROI",
}


def _weekly(name: str) -> Query:
    roi = ROI_DIGITS.get(name)
    if roi:
        return _on(name, lambda d: d.withColumn(roi, F.round(roi, 6)))
    return _on(name, lambda d: d)


def queries() -> dict[str, Query]:
    """Query name to a function of the session and the folder of the given tables."""
    found: dict[str, Query] = {}
    for table in SCHEMAS:
        found[f"scan_{table}"] = _source(lambda source, table=table: source(table, None))
    for name in TABLES:
        found[name] = _weekly(name)

    # loading and writing
    found["website_promotion_daily_uplift_top10_tidy"] = _with(
        lambda t: t["website_promotion_daily_uplift_top10_tidy"]
    )
    found["dataset_bing_ads"] = _with(lambda t: t["Bing Ads"])
    found["sink_roundtrip"] = _sink
    found["batch_outputs"] = _batch
    found["load_week_normalised"] = _with(_normalised)
    found["preview"] = _on(OVERALL, lambda d: report.preview(d, ["Week"]))

    # calendar and text
    found["week_start"] = _week_column("Week")
    found["week_start_tue"] = _week_column("Week", anchor="TUE")
    found["week_start_keep_time"] = _raw(
        "events",
        lambda d: d.select("event_id", dates.week_start("ts", keep_time=True).alias("Week")),
    )
    found["week_period_label"] = _raw(
        "orders",
        lambda d: d.select(
            "o_orderkey", dates.week_label(dates.week_start("o_orderdate")).alias("label")
        ),
    )
    found["parse_dates"] = _source(
        lambda source: source("bing_ads_stats", ["date", "campaign_name"]).withColumn(
            "day", dates.parse_day("date", strict=False)
        )
    )
    found["unify_source"] = _sales("marketordernumber", "websource", "cleaned_websource")
    found["unify_page_source"] = _raw(
        "pages", lambda d: d.select("page_id", text.unify_source("url").alias("channel"))
    )
    found["clean_campaign"] = _source(
        lambda source: source("website_sales", ["marketordernumber", "campaign"]).select(
            "marketordernumber",
            F.col("campaign").alias("raw"),
            text.clean_campaign("campaign").alias("campaign"),
        )
    )
    found["promo_label"] = _sales(
        "marketordernumber", "promotion", "promotionid", "promo_clean"
    )
    found["pricing_base"] = _sales(
        "marketordernumber", "pricingstrategy", "strategy_base", "is_test"
    )
    found["ads_cost_from_micros"] = _source(
        lambda source: prepare.with_cost(source("google_ads_stats", None)).select(
            "date", "campaign_name", "cost"
        )
    )

    # social ads
    found["fb_key"] = _source(
        lambda source: source("facebook_ads_insights", None).select(
            text.joined_key(*ads.AD_DAY).alias("primary_key"), "clicks"
        )
    )
    found["fb_purchase_actions"] = _source(
        lambda source: ads.purchase_actions(source("facebook_ads_actions", None))
    )
    found["fb_joined"] = _joined(fanout=True)
    found["fb_joined_preagg"] = _joined(fanout=False)

    # week ranges
    found["filter_week_range"] = Report(
        lambda tables: tables[OVERALL], cut=_between("1996-01-01", "1997-06-30")
    )
    for preset in wk.PRESETS:
        found[preset.lower().replace(" ", "_")] = _preset(OVERALL, preset)
    found["last_90_days_google_ads"] = _preset("google_ads_weekly_overall", "Last 90 Days")
    found["website_wow_series"] = _on(
        OVERALL,
        lambda d: wk.week_over_week(
            d.select("Week", "Total_Revenue"), "Total_Revenue", "Prev_Revenue", "Revenue_Change"
        ),
    )
    found["website_wow"] = _on(
        OVERALL,
        lambda d: wk.latest_change(
            d.select("Week", "Total_Revenue"), "Total_Revenue", "Prev_Revenue",
            "Revenue_Change", zero_when_unknown=True,
        ),
    )
    found["google_ads_wow"] = _on(
        "google_ads_weekly_overall",
        lambda d: wk.latest_change(
            d.select("Week", "Profit"), "Profit", "Prev_Profit", "Profit_Change"
        ),
    )
    found["ga_weekly_monday"] = _source(_monday_sessions)

    # cards
    found["kpi_website"] = _on(OVERALL, report.kpi_website, 4)
    found["kpi_website_weighted"] = _on(OVERALL, report.kpi_website_weighted, 4)
    found["kpi_facebook"] = _on("facebook_ads_weekly_campaign", report.kpi_facebook, 4)
    found["kpi_ga"] = _on(
        "ga_weekly_aggregation",
        lambda d: report.kpi_ga(d).withColumns(
            {"revenue": F.round("revenue", 4), "avg_bounce": F.round("avg_bounce", 6)}
        ),
    )
    found["kpi_google_ads"] = _on("google_ads_weekly_overall", report.kpi_google_ads, 5)
    found["kpi_bing"] = _on("bing_ads_weekly_overall", report.kpi_bing, 5)
    found["kpi_affiliate"] = _on("affiliate_sales_weekly_overall", report.kpi_affiliate, 4)
    found["affiliate_distinct_orders"] = _source(
        lambda source: rollup(
            source("affiliate_sales", ["marketordernumber"]),
            [],
            {"orders": m.distinct("marketordernumber")},
        )
    )
    for preset in wk.PRESETS:
        found[f"affiliate_distinct_orders_{preset.lower().replace(' ', '_')}"] = _on(
            ORDER_BITMAPS, lambda d: distinct.distinct_count(d, "orders"), cut=_last(preset)
        )
    found["profit_by_platform"] = _with(
        lambda t: report.profit_by_platform(
            t["bing_ads_weekly_overall"],
            t["facebook_ads_weekly_campaign"],
            t["google_ads_weekly_overall"],
        ),
        4,
    )

    # reports
    publishers = "affiliate_sales_weekly_publisher"
    authors = "website_top10_authors_by_profit_weekly"
    campaigns = "website_weekly_top_campaign"
    found["affiliate_share"] = _on(
        publishers,
        lambda d: report.affiliate_share(d).withColumn(
            "Percent_of_Total", F.round("Percent_of_Total", 8)
        ),
        cut=_whole,
    )
    found["top10_campaigns_by_revenue"] = _on(campaigns, report.top_campaigns_by_revenue, 4)
    found["overall_top_campaigns"] = _on(campaigns, report.overall_top_campaigns, 4)
    found["websource_top10_trend"] = _on(
        "website_websource_analysis",
        lambda d: keep_top_k(d, "cleaned_websource", m.total("Total_Revenue")),
        cut=_whole,
    )
    found["pricing_top10_trend"] = _with(
        lambda t: keep_top_k(_normalised(t), "strategy_base", m.total("Total_Revenue")), cut=_whole
    )
    found["promo_global_top10"] = _on(
        "website_promotion_top10_weekly", report.top_promotions, 4
    )
    found["promo_uplift_top10"] = _on(
        "website_promotion_daily_uplift_top10", report.top_uplifts, 4
    )
    found["promo_pivot_uplift"] = _with(_pivot_uplift, cut=_whole)
    found["best_strategy_combo"] = _on(
        "website_promotion_strategy_analysis", report.best_combinations
    )
    found["authors_top10"] = _on(authors, report.top_authors, 4)
    found["author_list"] = _on(authors, report.author_list)
    found["author_report"] = _on(authors, lambda d: report.author_report(d, AUTHOR), 4)
    found["author_trend"] = _on(authors, lambda d: report.author_trend(d, AUTHOR))
    found["ga_top_sources_period"] = _on("ga_weekly_top_sources", report.top_ga_sources, 4)
    found["fb_weekly_ratios"] = _on("facebook_ads_weekly_campaign", report.facebook_ratios)
    found["fb_period_totals"] = _on("facebook_ads_weekly_campaign", report.facebook_totals, 4)
    found["fb_top10_period"] = _on(
        "facebook_ads_top10_campaigns", report.top_facebook_campaigns, 4
    )
    found["bing_top10_period"] = _on("bing_ads_weekly_campaign", report.top_bing_campaigns, 5)
    found["affiliate_daily"] = _on(
        "affiliate_sales_weekly_overall", report.affiliate_daily, 4
    )
    found["affiliate_top10_period"] = _on(publishers, report.top_affiliates, 4)
    trends = {
        "weekly_trend": (
            OVERALL, "Total_Revenue", "Total_Profit", "Order_Count", "AOV", "Profit_Margin"
        ),
        "weekly_trend_ga": (
            "ga_weekly_aggregation", "Total_Purchase_Revenue", "Total_Sessions",
            "Avg_Bounce_Rate",
        ),
        "weekly_trend_google_ads": ("google_ads_weekly_overall", "Profit", "ROI"),
        "weekly_trend_facebook": ("facebook_ads_weekly_campaign", "cost", "revenue", "ROI"),
        "weekly_trend_bing": (
            "bing_ads_weekly_overall", "clicks", "cost", "Profit", "ROI", "CTR"
        ),
    }
    for name, (table, *columns) in trends.items():
        found[name] = _on(table, lambda d, columns=columns: report.weekly_trend(d, *columns))

    # exploration
    found["describe_numeric"] = _raw("lineitem", lambda d: _round(explore.describe(d), 4))
    found["describe_weekly"] = _on(OVERALL, explore.describe, 4)
    found["describe_week"] = _on(OVERALL, explore.describe_times)
    for method in ("pearson", "spearman", "kendall"):
        found[f"corr_{method}"] = _corr(method)
    found["corr_long"] = _on(
        OVERALL, lambda d: correlate.melt(correlate.corr(d, MEASURED)), 6
    )
    found["pivot_sum"] = _pivot("sum", digits=4)
    found["pivot_mean"] = _pivot("mean", digits=4)
    found["pivot_max"] = _pivot("max")
    found["pivot_min"] = _pivot("min")
    found["pivot_same_axis"] = _pivot("sum", "category", 4)
    # On the stored table, as a report does it: Catalyst would push the condition on a computed
    # label below the rollup and repeat the clean-up of the source for every rule.
    found["filter_contains"] = _on(
        "website_campaign_segmentation_analysis",
        lambda d: explore.contains(d, "cleaned_websource", "goo|FACE"),
        cut=_whole,
    )
    found["pivot_contains"] = _on(
        "website_campaign_segmentation_analysis",
        lambda d: explore.pivot(
            explore.contains(d, "cleaned_websource", "goo|FACE"),
            "campaign", "category", "Total_Revenue",
        ),
        4,
        cut=_whole,
    )
    found["xy_series"] = _on(
        OVERALL, lambda d: explore.xy_series(d, "Order_Count", "Total_Revenue")
    )
    found["scatter_matrix_pairs"] = _on(
        OVERALL, lambda d: explore.scatter_matrix(d, MEASURED[:4])
    )
    found["forecast_trend"] = _on(
        OVERALL, lambda d: forecast.forecast_trend(d, "Total_Profit", 30), 2
    )
    found["forecast_additive"] = _on(
        OVERALL, lambda d: forecast.forecast(d, "Total_Profit", 30), 1
    )
    found["forecast_components"] = _on(
        "website_category_analysis",
        lambda d: forecast.forecast(
            d, "Total_Profit", 30, series=["majorcategory"], components=True
        ),
        1,
    )
    # reports over a range of weeks
    for name in RANGED:
        found[f"{name}_last_90_days"] = replace(found[name], cut=_last("Last 90 Days"))
    for name in CARDS:
        found[f"{name}_no_weeks"] = replace(found[name], cut=_between("1900-01-01", "1900-12-31"))
    if llm:
        found |= llm.QUERIES
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL."""
    found = {name: oracle.statement(name) for name in queries() if name in oracle.STATEMENTS}
    if llm:
        found |= llm.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


__all__ = ["OUTPUTS", "entry", "oracle_sql", "queries"]
