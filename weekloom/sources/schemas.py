"""Columns of the seven source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "website_sales": """orderdate STRING, websource STRING, campaign STRING, promotion STRING,
        promotionid STRING, novusd DOUBLE, contributionmargin DOUBLE, marketordernumber BIGINT,
        shippingchargesusd DOUBLE, promodiscountsusd DOUBLE, grossprodpaymentorder DOUBLE,
        booksinorder INT, isreturningcustomer INT, category STRING, majorcategory STRING,
        country STRING, orderdestinationtype STRING, medium STRING, pricingstrategy STRING,
        author STRING""",
    "ga_sessions_revenue": """date STRING, landing_page STRING, campaign_name STRING,
        source STRING, device_category STRING, medium STRING, sessions BIGINT,
        bounce_rate DOUBLE, active_users BIGINT, purchase_revenue DOUBLE""",
    "google_ads_stats": """date STRING, campaign_name STRING, cost_micros BIGINT,
        conversions_value DOUBLE, impressions BIGINT, clicks BIGINT, conversions DOUBLE""",
    "facebook_ads_insights": """date STRING, campaign_id STRING, adset_id STRING, ad_id STRING,
        campaign_name STRING, spend DOUBLE, impressions BIGINT, clicks BIGINT""",
    "facebook_ads_actions": """date STRING, campaign_id STRING, adset_id STRING, ad_id STRING,
        action_type STRING, value DOUBLE""",
    "bing_ads_stats": """date STRING, campaign_name STRING, conversions_value DOUBLE,
        spend DOUBLE, impressions BIGINT, clicks BIGINT, conversions DOUBLE""",
    "affiliate_sales": """eventdate STRING, marketordernumber BIGINT, publishername STRING,
        saleamountusd DOUBLE, publishercommissionusd DOUBLE, cjfeeusd DOUBLE,
        orderdiscountusd DOUBLE, correctedamountusd DOUBLE""",
}

def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def check_columns(table: str, df: DataFrame, needed: list[str]) -> None:
    """Fail early, by name, when a source lacks columns an operator reads."""
    missing = [column for column in needed if column not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks the columns {missing}")
