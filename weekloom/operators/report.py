"""Summaries of weekly tables over a range of weeks.

Every function takes weekly tables that are already cut to the range.  The names ending in
``_pct`` are percentages; ``profit_pct`` relates profit to cost and ``revenue_pct`` revenue
to cost, which the platforms' cards both call return on investment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions import measures as m
from weekloom.operators.rank import top_k, top_k_groups
from weekloom.operators.rollup import rollup

AD_CARD = {
    "profit": m.minus("revenue", "cost"),
    "ctr_pct": m.percent("clicks", "impressions"),
    "cpc": m.Ratio("cost", "clicks"),
}


def _zero_when_empty(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


# -- cards -------------------------------------------------------------------------------


def kpi_website(overall: DataFrame) -> DataFrame:
    """Revenue and profit, and the plain average of the weekly margins and order values."""
    card = rollup(
        overall,
        [],
        {
            "total_revenue": m.total("Total_Revenue"),
            "total_profit": m.total("Total_Profit"),
            "avg_margin": m.mean("Profit_Margin"),
            "avg_aov": m.mean("AOV"),
        },
    )
    return _zero_when_empty(card, "avg_margin", "avg_aov")


def kpi_website_weighted(overall: DataFrame) -> DataFrame:
    """As :func:`kpi_website`, with margin and order value of the whole range."""
    return rollup(
        overall,
        [],
        {
            "total_revenue": m.total("Total_Revenue"),
            "total_profit": m.total("Total_Profit"),
            "order_count": m.total("Order_Count"),
        },
        {
            "margin": m.percent("total_profit", "total_revenue"),
            "aov": m.Ratio("total_revenue", "order_count"),
        },
    )


def kpi_facebook(overall: DataFrame) -> DataFrame:
    return rollup(
        overall,
        [],
        {
            "revenue": m.total("revenue"),
            "cost": m.total("cost"),
            "impressions": m.total("impressions"),
            "clicks": m.total("clicks"),
        },
        AD_CARD | {"revenue_pct": m.percent("revenue", "cost")},
    )


def kpi_ga(overall: DataFrame) -> DataFrame:
    card = rollup(
        overall,
        [],
        {
            "sessions": m.total("Total_Sessions"),
            "revenue": m.total("Total_Purchase_Revenue"),
            "avg_bounce": m.mean("Avg_Bounce_Rate"),
        },
    )
    return _zero_when_empty(card, "avg_bounce")


def _ad_card(overall: DataFrame) -> DataFrame:
    card = rollup(
        overall,
        [],
        {
            "revenue": m.total("conversions_value"),
            "cost": m.total("cost"),
            "impressions": m.total("impressions"),
            "clicks": m.total("clicks"),
            "conversions": m.total("conversions"),
            "total_profit": m.total("Profit"),
            "avg_roi": m.mean("ROI"),
            "avg_ctr": m.mean("CTR"),
        },
        AD_CARD | {"revenue_pct": m.percent("revenue", "cost")},
    )
    card = card.withColumns(
        {
            "profit_pct": m.safe_div("profit", "cost", 100),
            "avg_roi_pct": F.col("avg_roi") * F.lit(100),
        }
    )
    return _zero_when_empty(card, "avg_roi_pct", "avg_ctr")


def kpi_google_ads(overall: DataFrame) -> DataFrame:
    return _ad_card(overall).select(
        "cost", "revenue", "profit", "profit_pct", "ctr_pct", "cpc", "total_profit",
        "avg_roi_pct",
    )


def kpi_bing(overall: DataFrame) -> DataFrame:
    return _ad_card(overall).select(
        "cost", "revenue", "profit", "revenue_pct", "ctr_pct", "cpc", "conversions",
        "impressions", "clicks", "total_profit", "avg_roi_pct", "avg_ctr",
    )


def kpi_affiliate(overall: DataFrame) -> DataFrame:
    """Sums of the weekly figures and their average per order; NULL without orders."""
    card = rollup(
        overall,
        [],
        {
            "sales": m.total("Total_Sales"),
            "commission": m.total("Total_Commission"),
            "net": m.total("Net_After_Commission"),
            "orders": m.total("Order_Count"),
            "fees": m.total("Total_Fees"),
            "discount": m.total("Total_Discount"),
        },
    )
    orders = F.col("orders").cast("double")
    return card.withColumns(
        {f"avg_{c}": F.try_divide(F.col(c), orders) for c in ("commission", "sales", "net")}
    )


def profit_by_platform(bing: DataFrame, facebook: DataFrame, google: DataFrame) -> DataFrame:
    """Profit of the three ad platforms, 0 for one without data."""
    parts = [
        ("Bing Ads", bing, "conversions_value"),
        ("Facebook Ads", facebook, "revenue"),
        ("Google Ads", google, "conversions_value"),
    ]
    rows = [
        rollup(
            df,
            [],
            {"value": m.total(value), "cost": m.total("cost")},
            {"Profit": m.minus("value", "cost")},
        ).select(F.lit(name).alias("Platform"), "Profit")
        for name, df, value in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# -- website -----------------------------------------------------------------------------


def top_campaigns_by_revenue(top_campaigns: DataFrame, k: int = 10) -> DataFrame:
    return top_k_groups(
        top_campaigns,
        "campaign",
        {"Total_Revenue": m.total("Total_Revenue"), "Total_Profit": m.total("Total_Profit")},
        "Total_Revenue",
        k,
    )


def overall_top_campaigns(top_campaigns: DataFrame, k: int = 10) -> DataFrame:
    return top_k_groups(
        top_campaigns,
        "campaign",
        {
            "Total_Profit": m.total("Total_Profit"),
            "Total_Revenue": m.total("Total_Revenue"),
            "Order_Count": m.total("Order_Count"),
            "Profit_Margin": m.mean("Profit_Margin"),
        },
        "Total_Profit",
        k,
    )


def top_promotions(promo_top10: DataFrame, k: int = 10) -> DataFrame:
    columns = ("total_profit", "total_revenue", "total_orders")
    return top_k_groups(
        promo_top10, "promo_clean", {c: m.total(c) for c in columns}, "total_profit", k
    )


def top_uplifts(uplift: DataFrame, k: int = 10) -> DataFrame:
    columns = ("revenue_lift", "profit_lift", "orders_lift")
    return top_k_groups(
        uplift, "promo_clean", {c: m.mean(c) for c in columns}, "revenue_lift", k
    )


def best_combinations(strategies: DataFrame, k: int = 5) -> DataFrame:
    """The weekly combinations with the highest profit, then margin; the first is the advice."""
    ties = ("Week", "promo_clean", "campaign", "pricingstrategy", "category")
    return top_k(strategies, ["Total_Profit", "Profit_Margin"], k, ties)


# -- authors -----------------------------------------------------------------------------


def top_authors(authors: DataFrame, k: int = 10) -> DataFrame:
    return top_k_groups(
        authors, "author", {"Total_Revenue": m.total("Total_Revenue")}, "Total_Revenue", k
    )


def author_list(authors: DataFrame) -> DataFrame:
    return authors.select("author").distinct().orderBy("author")


def author_report(authors: DataFrame, author: str) -> DataFrame:
    """Books, revenue and profit of one author over the range."""
    one = authors.where(F.col("author") == author)
    return rollup(
        one,
        ["author"],
        {
            "total_books": m.total("Total_Books"),
            "total_revenue": m.total("Total_Revenue"),
            "total_profit": m.total("Total_Profit"),
        },
    )


def author_trend(authors: DataFrame, author: str) -> DataFrame:
    one = authors.where(F.col("author") == author)
    return weekly_trend(one, "Total_Revenue", "Total_Profit", "Total_Books")


# -- sessions, ads -----------------------------------------------------------------------


def top_ga_sources(ga_top: DataFrame, k: int = 10) -> DataFrame:
    columns = ("Total_Purchase_Revenue", "Total_Sessions")
    return top_k_groups(
        ga_top, "source", {c: m.total(c) for c in columns}, "Total_Purchase_Revenue", k
    )


def facebook_ratios(overall: DataFrame) -> DataFrame:
    """The weekly ratios, computed again from the stored sums."""
    sums = overall.select("Week", "revenue", "cost", "impressions", "clicks")
    return m.with_derived(sums, m.SOCIAL_RATIOS)


def facebook_totals(overall: DataFrame) -> DataFrame:
    return rollup(
        overall,
        [],
        {"total_revenue": m.total("revenue"), "total_cost": m.total("cost")},
        {
            "total_profit": m.minus("total_revenue", "total_cost"),
            "overall_roi": m.Ratio("total_revenue", "total_cost"),
        },
    )


def top_facebook_campaigns(fb_top: DataFrame, k: int = 10) -> DataFrame:
    return top_k_groups(
        fb_top,
        "campaign_name",
        {"revenue": m.total("revenue"), "cost": m.total("cost")},
        "Profit",
        k,
        {"Profit": m.minus("revenue", "cost")},
    )


def top_bing_campaigns(campaigns: DataFrame, k: int = 10) -> DataFrame:
    columns = ("Profit", "conversions_value", "clicks", "impressions")
    return top_k_groups(
        campaigns,
        "campaign_name",
        {c: m.total(c) for c in columns} | {"ROI": m.mean("ROI")},
        "Profit",
        k,
    )


# -- affiliates --------------------------------------------------------------------------


def share_of_total(
    df: DataFrame, metric: str, ties: tuple[str, ...], k: int = 10
) -> DataFrame:
    """The ``k`` best rows with their percentage of the sum over all rows.

    The sum is a scalar subquery, so no row meets it in a join or a one-partition window.  Both
    read ``df``, which should be a stored table.
    """
    whole = df.agg(F.sum(metric)).scalar()
    share = F.try_divide(F.col(metric), whole) * F.lit(100)
    return top_k(df, metric, k, ties).withColumn("Percent_of_Total", share)


def affiliate_share(publishers: DataFrame, k: int = 10) -> DataFrame:
    """The best publisher-weeks: a publisher may appear once per week."""
    return share_of_total(publishers, "Total_Sales", ("Week", "publishername"), k)


def affiliate_daily(overall: DataFrame) -> DataFrame:
    daily = overall.withColumn("Date", F.to_date("Week"))
    return rollup(daily, ["Date"], {"Total_Sales": m.total("Total_Sales")})


def top_affiliates(publishers: DataFrame, k: int = 10) -> DataFrame:
    """Sums per publisher; an order counts once for each week it appears in."""
    columns = ("Total_Sales", "Total_Commission", "Net_After_Commission", "Order_Count")
    return top_k_groups(
        publishers, "publishername", {c: m.total(c) for c in columns}, "Total_Sales", k
    )


# -- series ------------------------------------------------------------------------------


def weekly_trend(df: DataFrame, *columns: str) -> DataFrame:
    """The given columns of a weekly table in week order."""
    return df.select("Week", *columns).orderBy("Week")


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
