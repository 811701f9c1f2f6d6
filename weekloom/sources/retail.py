"""The seven source tables derived from a retail star schema.

Money is DECIMAL with enough digits that no value is rounded, so sums are exact whatever the
order of the rows.  ``website_sales`` joins only the tables whose columns are asked for, each
with the order lines on the left: keys of the other tables are unique, so no join adds or drops
a line, and leaving an unused one out spares a shuffle of the largest table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.sources.tables import Source, spread

# Given with each read: finding a schema takes a job, and one kept could be out of date.
RAW = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING,
        p_retailprice DOUBLE""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE""",
}


def retail_source(spark: SparkSession, sf_dir: str) -> Source:
    """Source tables computed from the parquet files in ``sf_dir``."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(RAW[name]).parquet(f"{sf_dir}/{name}.parquet")

    def read(name: str, columns: Sequence[str] | None = None) -> DataFrame:
        if name == "website_sales":
            return _website_sales(table, columns)
        df = _BUILDERS[name](table)
        return df if columns is None else df.select(*columns)

    return read


# Each column of website_sales with the tables it needs besides lineitem.
WEBSITE_SALES: dict[str, tuple[str, tuple[str, ...]]] = {
    "orderdate": ("CAST(CAST(o_orderdate AS DATE) AS STRING)", ("orders",)),
    "websource": (
        """CASE l_suppkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN '(direct)'
        WHEN 3 THEN 'https://m.facebook.com/ads?id=1' WHEN 4 THEN 'https://www.Google.com/'
        WHEN 5 THEN 'bing' WHEN 6 THEN 'search.yahoo.com' WHEN 7 THEN 'duckduckgo.com/'
        WHEN 8 THEN 'my-affiliate-site' WHEN 9 THEN 'Klaviyo' WHEN 10 THEN 'attentive'
        WHEN 11 THEN 'sendinblue' WHEN 12 THEN 'convertkit' WHEN 13 THEN 'cj_feed'
        WHEN 14 THEN 'x.substack.com' WHEN 15 THEN 'chatgpt.com' WHEN 16 THEN 'trustpilot'
        WHEN 17 THEN 'linkin.bio/a' WHEN 18 THEN 'nps-mail'
        ELSE 'Blog.Example.org/?page=2' END""",
        (),
    ),
    "campaign": (
        """CASE l_partkey % 16 WHEN 0 THEN NULL WHEN 1 THEN '!!!' WHEN 2 THEN 'GCLID'
        WHEN 3 THEN 'www.google.com' WHEN 4 THEN ' Spring  Sale! ' WHEN 5 THEN 'spring_sale'
        ELSE concat('Camp #', CAST(l_partkey % 16 AS STRING)) END""",
        (),
    ),
    "promotion": (
        """CASE WHEN l_discount < 0.005D THEN NULL
        WHEN l_discount < 0.035D THEN ' NoPromotionApplied ' ELSE 'PromotionApplied' END""",
        (),
    ),
    "promotionid": (
        "CASE WHEN l_linenumber <> 7 THEN concat(' ', p_brand, ' ') END", ("part",)
    ),
    "novusd": ("CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))", ()),
    "contributionmargin": (
        """CAST(l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice
        AS DECIMAL(18,4))""",
        ("part",),
    ),
    "marketordernumber": ("l_orderkey", ()),
    "shippingchargesusd": ("CAST(l_extendedprice * l_tax AS DECIMAL(18,4))", ()),
    "promodiscountsusd": ("CAST(l_extendedprice * l_discount AS DECIMAL(18,4))", ()),
    "grossprodpaymentorder": ("CAST(l_extendedprice AS DECIMAL(18,4))", ()),
    "booksinorder": ("CAST(l_quantity AS INT)", ()),
    "isreturningcustomer": ("CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END", ("orders",)),
    "category": ("p_type", ("part",)),
    "majorcategory": ("p_brand", ("part",)),
    "country": ("n_name", ("orders", "customer")),
    "orderdestinationtype": (
        "CASE WHEN n_regionkey = 0 THEN 'Domestic' ELSE 'International' END",
        ("orders", "customer"),
    ),
    "medium": ("o_orderpriority", ("orders",)),
    "pricingstrategy": (
        """CASE WHEN l_linenumber <> 5 THEN concat(
        CASE l_returnflag WHEN 'A' THEN 'Dynamic' WHEN 'N' THEN 'Static' ELSE 'Clearance' END,
        CASE WHEN l_linestatus = 'F' THEN 'Test' ELSE '' END) END""",
        (),
    ),
    "author": ("p_name", ("part",)),
}


def _website_sales(
    table: Callable[[str], DataFrame], columns: Sequence[str] | None
) -> DataFrame:
    names = list(WEBSITE_SALES if columns is None else columns)
    tables = {t for name in names for t in WEBSITE_SALES[name][1]}
    rows = spread(table("lineitem"), "l_orderkey", "l_linenumber")
    if "part" in tables:
        rows = rows.join(table("part"), F.expr("l_partkey = p_partkey"), "left")
    if "orders" in tables:
        orders = table("orders")
        if "customer" in tables:
            homes = F.expr("c_nationkey = n_nationkey")
            homes = table("customer").join(table("nation"), homes, "left")
            orders = orders.join(homes, F.expr("o_custkey = c_custkey"), "left")
        rows = rows.join(orders, F.expr("l_orderkey = o_orderkey"), "left")
    return rows.selectExpr(*(f"{WEBSITE_SALES[name][0]} AS {name}" for name in names))


def _ga_sessions(table: Callable[[str], DataFrame]) -> DataFrame:
    return spread(table("events"), "event_id").selectExpr(
        "date_format(ts, 'MM/dd/yyyy') AS date",
        """CASE WHEN event_id % 9 <> 0 THEN concat('/p', CAST(event_id % 5 AS STRING)) END
        AS landing_page""",
        "concat('ga-', CAST(event_id % 8 AS STRING)) AS campaign_name",
        "concat('src', CAST(user_id % 12 AS STRING)) AS source",
        """CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
        AS device_category""",
        "event_type AS medium",
        "1 + event_id % 3 AS sessions",
        "CAST(value / 1000 AS DECIMAL(18,6)) AS bounce_rate",
        "CAST(1 AS BIGINT) AS active_users",
        """CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS DECIMAL(18,4))
        AS purchase_revenue""",
    )


_CONVERSIONS = (
    """CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_extendedprice / 1000 END
    AS DECIMAL(18,6)) AS conversions_value""",
    "l_linenumber % 3 AS conversions",
)


def _google_ads(table: Callable[[str], DataFrame]) -> DataFrame:
    return spread(table("lineitem"), "l_orderkey", "l_linenumber").selectExpr(
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS date",
        "concat('gads-', CAST(l_suppkey % 40 AS STRING)) AS campaign_name",
        "CAST(l_quantity * 1000000 AS BIGINT) AS cost_micros",
        "l_partkey % 500 AS impressions",
        "l_partkey % 20 AS clicks",
        *_CONVERSIONS,
    )


def _bing_ads(table: Callable[[str], DataFrame]) -> DataFrame:
    lines = spread(table("lineitem"), "l_orderkey", "l_linenumber")
    return lines.where("l_returnflag = 'R'").selectExpr(
        """CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING)
        END AS date""",
        "concat('bing-', CAST(l_suppkey % 30 AS STRING)) AS campaign_name",
        "CAST(l_quantity AS DECIMAL(18,4)) AS spend",
        "l_partkey % 400 AS impressions",
        "l_partkey % 15 AS clicks",
        *_CONVERSIONS,
    )


_AD_IDS = (
    "CAST(user_id % 30 AS STRING) AS campaign_id",
    "CASE WHEN user_id % 11 <> 0 THEN CAST(user_id % 7 AS STRING) END AS adset_id",
    "CAST(user_id AS STRING) AS ad_id",
)


def _ad_insights(table: Callable[[str], DataFrame]) -> DataFrame:
    seen = spread(table("events"), "event_id").where("event_type IN ('view', 'click')")
    daily = seen.groupBy(F.expr("CAST(ts AS DATE) AS day"), "user_id").agg(
        F.expr("""sum(CAST(CASE WHEN event_type = 'click' THEN value ELSE 0 END
        AS DECIMAL(18,4))) AS spend"""),
        F.expr("sum(CASE WHEN event_type = 'view' THEN 100 ELSE 0 END) AS impressions"),
        F.expr("sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks"),
    )
    return daily.selectExpr(
        "CAST(day AS STRING) AS date",
        *_AD_IDS,
        """CASE WHEN user_id % 30 <> 29 THEN concat('fb-', CAST(user_id % 30 AS STRING)) END
        AS campaign_name""",
        "spend",
        "impressions",
        "clicks",
    )


def _ad_actions(table: Callable[[str], DataFrame]) -> DataFrame:
    acts = spread(table("events"), "event_id")
    return acts.where("event_type IN ('purchase', 'signup', 'error')").selectExpr(
        "CAST(CAST(ts AS DATE) AS STRING) AS date",
        *_AD_IDS,
        """CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'omni_purchase'
        ELSE 'link_click' END AS action_type""",
        "CAST(value AS DECIMAL(18,4)) AS value",
    )


def _affiliate_sales(table: Callable[[str], DataFrame]) -> DataFrame:
    return spread(table("orders"), "o_orderkey").selectExpr(
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS eventdate",
        "o_orderkey - o_orderkey % 2 AS marketordernumber",
        "concat('pub-', CAST(o_custkey % 60 AS STRING)) AS publishername",
        "CAST(o_totalprice AS DECIMAL(18,4)) AS saleamountusd",
        "CAST(o_totalprice * 0.07D AS DECIMAL(18,4)) AS publishercommissionusd",
        "CAST(o_totalprice * 0.02D AS DECIMAL(18,4)) AS cjfeeusd",
        "CAST(o_totalprice * 0.01D AS DECIMAL(18,4)) AS orderdiscountusd",
        """CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS DECIMAL(18,4))
        AS correctedamountusd""",
    )


_BUILDERS = {
    "ga_sessions_revenue": _ga_sessions,
    "google_ads_stats": _google_ads,
    "bing_ads_stats": _bing_ads,
    "facebook_ads_insights": _ad_insights,
    "facebook_ads_actions": _ad_actions,
    "affiliate_sales": _affiliate_sales,
}
