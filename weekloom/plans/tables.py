"""Definitions of the weekly tables and of the steps between them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions import measures as m
from weekloom.functions.dates import week_label
from weekloom.functions.text import NO_PROMOTION
from weekloom.operators import uplift
from weekloom.operators.rank import top_n_per_group
from weekloom.operators.exact import is_double
from weekloom.operators.rollup import rollup, rollup_late, rollup_parts
from weekloom.operators.weeks import normalise_week
from weekloom.plans.prepare import LATE, PREPARED
from weekloom.sources.tables import Source


@dataclass(frozen=True)
class Rollup:
    """Measures of a prepared source by keys."""

    source: str
    keys: tuple[str, ...]
    measures: Mapping[str, m.Measure]
    derived: Mapping[str, m.Ratio | m.Difference] = field(default_factory=dict)
    nullable: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()
    label_week: bool = False
    #: Whether rules for keys run on groups instead of rows, where the rows are not cleaned already.
    late: bool = False

    def columns(self) -> list[str]:
        return [*self.keys, *(measure.column for measure in self.measures.values())]

    @property
    def in_groups(self) -> bool:
        """Whether groups by the keys in GROUPS have all this table needs."""
        additive = all(measure.how in ("sum", "count") for measure in self.measures.values())
        return additive and set(self.keys) <= set(GROUPS.get(self.source, ()))

    def build(self, tables: Tables) -> DataFrame:
        late = {key: LATE[key] for key in self.keys if key in LATE} if self.late else {}
        if late and not tables.is_staged(self.source):
            columns = [late[c][0] if c in late else c for c in self.columns()]
            rows = tables.prepared(self.source, columns)
            if not any(is_double(rows.schema[m.column].dataType) for m in self.measures.values()):
                return rollup_late(
                    rows, self.keys, late, self.measures, self.derived, self.nullable
                ).drop(*self.hidden)
        groups = tables.groups(self.source) if self.in_groups else None
        if groups is not None:
            out = rollup_parts(groups, self.keys, self.measures, self.derived, self.nullable)
        else:
            rows = tables.prepared(self.source, self.columns())
            out = rollup(rows, self.keys, self.measures, self.derived, self.nullable, exact=True)
        if self.label_week:
            out = out.withColumn("Week", week_label("Week"))
        return out.drop(*self.hidden)


@dataclass(frozen=True)
class Top:
    """The best rows of each week of another table."""

    of: str
    by: str
    ties: tuple[str, ...]
    n: int = 10
    without: str | None = None
    drop_null_metric: bool = False

    def build(self, tables: Tables) -> DataFrame:
        rows = tables[self.of]
        if self.without is not None:
            rows = rows.where(F.col(self.ties[0]) != self.without)
        return top_n_per_group(rows, "Week", self.by, self.n, self.ties, self.drop_null_metric)


@dataclass(frozen=True)
class Same:
    """Another table under a second name."""

    of: str

    def build(self, tables: Tables) -> DataFrame:
        return tables[self.of]


@dataclass(frozen=True)
class Step:
    """A function of prepared columns."""

    source: str
    reads: tuple[str, ...]
    function: Callable[[DataFrame], DataFrame]

    def columns(self) -> list[str]:
        return list(self.reads)

    def build(self, tables: Tables) -> DataFrame:
        return self.function(tables.prepared(self.source, self.columns()))


#: Keys of prepared sources that several tables are rolled up by, alone or together.  Groups of them can be kept.
GROUPS = {
    "website_sales": ("Week", "campaign", "cleaned_websource", "category", "isreturningcustomer"),
    "google_ads_stats": ("Week", "campaign_name"),
    "bing_ads_stats": ("Week", "campaign_name"),
}

PROMO_COLUMNS = (
    "Week", "promo_clean", "order_ts", "novusd", "contributionmargin", "marketordernumber",
)
_ROI = {"roi_sum": m.total("roi_sum"), "rows": m.total("rows")}
_AD_SUMS = {
    "revenue": m.total("revenue"),
    "cost": m.total("cost"),
    "impressions": m.total("impressions"),
    "clicks": m.total("clicks"),
}

TABLES: dict[str, Rollup | Top | Same | Step] = {
    # website
    "website_weekly_campaign": Rollup(
        "website_sales", ("Week", "campaign"), m.ORDER_TOTALS, m.ORDER_RATIOS
    ),
    "website_weekly_top_campaign": Top(
        "website_weekly_campaign", "Total_Profit", ("campaign",)
    ),
    "website_campaign_analysis": Same("website_weekly_campaign"),
    "website_campaign_segmentation_analysis": Rollup(
        "website_sales",
        ("Week", "campaign", "cleaned_websource", "category", "isreturningcustomer"),
        m.SALES_TOTALS,
        m.SALES_RATIOS,
    ),
    "promo_weekly_metrics": Rollup(
        "website_sales", ("Week", "promo_clean"), uplift.PROMO_TOTALS
    ),
    "website_promotion_top10_weekly": Top(
        "promo_weekly_metrics", "total_profit", ("promo_clean",), without=NO_PROMOTION
    ),
    "promo_daily_averages": Step("website_sales", PROMO_COLUMNS, uplift.daily_averages),
    "website_promotion_daily_uplift_top10": Step(
        "website_sales", PROMO_COLUMNS, uplift.promo_uplift
    ),
    "promotion_segments": Rollup(
        "website_sales",
        ("Week", "promo_clean", "cleaned_websource", "category", "isreturningcustomer"),
        m.DISCOUNT_TOTALS,
        m.SALES_RATIOS | m.DISCOUNT_RATIO,
    ),
    "website_promotion_analysis": Top(
        "promotion_segments",
        "Total_Profit",
        ("promo_clean", "cleaned_websource", "category", "isreturningcustomer"),
    ),
    "website_customer_analysis": Rollup(
        "website_sales",
        ("Week", "isreturningcustomer"),
        {"Total_Revenue": m.total("novusd"), "Order_Count": m.count("marketordernumber")},
    ),
    "website_geo_source_analysis": Rollup(
        "website_sales",
        ("Week", "country", "orderdestinationtype", "cleaned_websource", "medium"),
        {"Total_Revenue": m.total("novusd"), "Order_Count": m.count("marketordernumber")},
        late=True,
    ),
    "website_websource_analysis": Rollup(
        "website_sales",
        ("Week", "cleaned_websource"),
        {
            "Total_Revenue": m.total("novusd"),
            "Total_Total": m.total("contributionmargin"),
            "Order_Count": m.count("marketordernumber"),
        },
        {
            "AOV": m.Ratio("Total_Revenue", "Order_Count"),
            "Profit_Margin": m.percent("Total_Total", "Total_Revenue"),
        },
        late=True,
    ),
    "promotion_strategy_segments": Rollup(
        "website_sales",
        ("Week", "promo_clean", "campaign", "pricingstrategy", "category"),
        m.DISCOUNT_TOTALS,
        {"Profit_Margin": m.SALES_RATIOS["Profit_Margin"]} | m.DISCOUNT_RATIO,
    ),
    "website_promotion_strategy_analysis": Top(
        "promotion_strategy_segments",
        "Total_Profit",
        ("promo_clean", "campaign", "pricingstrategy", "category"),
    ),
    "website_author_analysis": Rollup(
        "website_sales",
        ("Week", "author"),
        m.SALES_TOTALS | {"Total_Books": m.total("booksinorder")},
        m.SALES_RATIOS,
    ),
    "website_top10_authors_by_profit_weekly": Top(
        "website_author_analysis", "Total_Profit", ("author",)
    ),
    "website_category_analysis": Rollup(
        "website_sales", ("Week", "majorcategory"), m.SALES_TOTALS, m.SALES_RATIOS
    ),
    "pricing_test_counts": Rollup(
        "website_sales", ("strategy_base", "is_test"), {"count": m.count("is_test")}
    ),
    "website_pricing_strategy_analysis": Rollup(
        "website_sales",
        ("Week", "strategy_base", "is_test"),
        m.SALES_TOTALS,
        m.SALES_RATIOS,
        nullable=("Week",),
        label_week=True,
    ),
    "website_weekly_overall": Rollup(
        "website_sales", ("Week",), m.ORDER_TOTALS, m.ORDER_RATIOS
    ),
    # web sessions
    "ga_weekly_aggregation": Rollup("ga_sessions_revenue", ("Week",), m.SESSION_TOTALS),
    "ga_weekly_dimensions": Rollup(
        "ga_sessions_revenue",
        ("Week", "campaign_name", "source", "device_category", "landing_page", "medium"),
        m.SESSION_TOTALS,
    ),
    "ga_weekly_top_sources": Top(
        "ga_weekly_dimensions",
        "Total_Purchase_Revenue",
        ("campaign_name", "source", "device_category", "landing_page", "medium"),
    ),
    # search ads
    "google_ads_weekly_overall": Rollup(
        "google_ads_stats", ("Week",), m.AD_TOTALS, m.AD_RATIOS
    ),
    "google_ads_weekly_campaign": Rollup(
        "google_ads_stats", ("Week", "campaign_name"), m.AD_TOTALS, m.AD_RATIOS
    ),
    "google_ads_weekly_top_campaign": Top(
        "google_ads_weekly_campaign", "Profit", ("campaign_name",)
    ),
    "bing_ads_weekly_overall": Rollup("bing_ads_stats", ("Week",), m.AD_TOTALS, m.AD_RATIOS),
    "bing_ads_weekly_campaign": Rollup(
        "bing_ads_stats", ("Week", "campaign_name"), m.AD_TOTALS, m.AD_RATIOS
    ),
    "bing_ads_weekly_top_campaign": Top(
        "bing_ads_weekly_campaign", "Profit", ("campaign_name",), drop_null_metric=True
    ),
    # social ads
    "fb_weekly_campaigns": Rollup(
        "facebook_ads",
        ("Week", "campaign_name"),
        _AD_SUMS | _ROI,
        {"ROI": m.Ratio("roi_sum", "rows", default=None)},
        nullable=("Week", "campaign_name"),
        hidden=("roi_sum", "rows"),
    ),
    "facebook_ads_top10_campaigns": Top("fb_weekly_campaigns", "revenue", ("campaign_name",)),
    "facebook_ads_weekly_campaign": Rollup(
        "facebook_ads", ("Week",), _AD_SUMS, m.SOCIAL_RATIOS
    ),
    "facebook_ads_weekly_aggregated": Rollup(
        "facebook_ads",
        ("Week",),
        {
            "Total_Value": m.total("revenue"),
            "Total_Spend": m.total("cost"),
            "Total_Impressions": m.total("impressions"),
            "Total_Clicks": m.total("clicks"),
        }
        | _ROI,
        {"Avg_ROI": m.Ratio("roi_sum", "rows", default=None)},
        hidden=("roi_sum", "rows"),
    ),
    # affiliates
    "affiliate_sales_weekly_overall": Rollup(
        "affiliate_sales",
        ("Week",),
        {
            "Order_Count": m.distinct("marketordernumber"),
            "Total_Sales": m.total("saleamountusd"),
            "Total_Commission": m.total("publishercommissionusd"),
            "Total_Fees": m.total("cjfeeusd"),
            "Total_Discount": m.total("orderdiscountusd"),
            "Corrected_Amount": m.total("correctedamountusd"),
        },
        {"Net_After_Commission": m.minus("Total_Sales", "Total_Commission", "Total_Fees")},
    ),
    "affiliate_sales_weekly_publisher": Rollup(
        "affiliate_sales",
        ("Week", "publishername"),
        {
            "Order_Count": m.distinct("marketordernumber"),
            "Total_Sales": m.total("saleamountusd"),
            "Total_Commission": m.total("publishercommissionusd"),
        },
        {"Net_After_Commission": m.minus("Total_Sales", "Total_Commission")},
    ),
    "affiliate_sales_weekly_top_publisher": Top(
        "affiliate_sales_weekly_publisher", "Net_After_Commission", ("publishername",)
    ),
}

# Steps on the way to other tables, which a batch run does not write.
INTERMEDIATE = frozenset(
    {
        "promo_weekly_metrics",
        "promo_daily_averages",
        "promotion_segments",
        "promotion_strategy_segments",
        "pricing_test_counts",
        "ga_weekly_dimensions",
        "fb_weekly_campaigns",
    }
)
OUTPUTS = tuple(name for name in TABLES if name not in INTERMEDIATE)

# The report side asks for this table by a second name.
ALIASES = {
    "website_promotion_daily_uplift_top10_tidy": "website_promotion_daily_uplift_top10"
}

# Data sets offered for exploration.
DATASETS = {
    "Website Sales Overall": "website_weekly_overall",
    "Google Analytics": "ga_weekly_aggregation",
    "Affiliate Sales": "affiliate_sales_weekly_overall",
    "Google Ads": "google_ads_weekly_overall",
    "Facebook Ads": "facebook_ads_weekly_campaign",
    "Bing Ads": "bing_ads_weekly_overall",
}


class Tables:
    """Weekly tables by name, computed from a source, or read where already written."""

    def __init__(
        self,
        source: Source,
        staged: Mapping[str, DataFrame] | None = None,
        written: Mapping[str, DataFrame] | None = None,
        groups: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self._source = source
        self._staged = dict(staged or {})
        self._written = dict(written or {})
        self._groups = dict(groups or {})

    def is_staged(self, source: str) -> bool:
        return source in self._staged

    def groups(self, source: str) -> DataFrame | None:
        """Kept groups of a prepared source by the keys in GROUPS."""
        return self._groups.get(source)

    def prepared(self, source: str, columns: list[str]) -> DataFrame:
        if source in self._staged:
            return self._staged[source].select(*dict.fromkeys(columns))
        return PREPARED[source](self._source, columns)

    def __getitem__(self, name: str) -> DataFrame:
        name = DATASETS.get(name, ALIASES.get(name, name))
        if name in self._written:
            return self._written[name]
        return TABLES[name].build(self)


class Range:
    """Weekly tables cut by ``keep``, the way every report over a range of weeks reads them.

    Tables that store their week as a label come with a timestamp, as a range needs one.
    """

    def __init__(self, tables: Tables, keep: Callable[[DataFrame], DataFrame]) -> None:
        self._tables = tables
        self._keep = keep

    def __getitem__(self, name: str) -> DataFrame:
        rows = self._tables[name]
        labelled = getattr(TABLES.get(name), "label_week", False)
        return self._keep(normalise_week(rows) if labelled else rows)
