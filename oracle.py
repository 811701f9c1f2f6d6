"""Reference SQL for the registered queries, written for DuckDB.

The text is independent of the Spark code: source views over the driver tables, cleaned views,
weekly tables, and a statement per query.  :func:`statement` prefixes a statement with the
views it needs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# -- source views (FIXTURES.md) ----------------------------------------------------------

VIEWS["website_sales"] = """
SELECT CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS orderdate,
  CASE l.l_suppkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN '(direct)'
    WHEN 3 THEN 'https://m.facebook.com/ads?id=1' WHEN 4 THEN 'https://www.Google.com/'
    WHEN 5 THEN 'bing' WHEN 6 THEN 'search.yahoo.com' WHEN 7 THEN 'duckduckgo.com/'
    WHEN 8 THEN 'my-affiliate-site' WHEN 9 THEN 'Klaviyo' WHEN 10 THEN 'attentive'
    WHEN 11 THEN 'sendinblue' WHEN 12 THEN 'convertkit' WHEN 13 THEN 'cj_feed'
    WHEN 14 THEN 'x.substack.com' WHEN 15 THEN 'chatgpt.com' WHEN 16 THEN 'trustpilot'
    WHEN 17 THEN 'linkin.bio/a' WHEN 18 THEN 'nps-mail' ELSE 'Blog.Example.org/?page=2'
  END AS websource,
  CASE l.l_partkey % 16 WHEN 0 THEN NULL WHEN 1 THEN '!!!' WHEN 2 THEN 'GCLID'
    WHEN 3 THEN 'www.google.com' WHEN 4 THEN ' Spring  Sale! ' WHEN 5 THEN 'spring_sale'
    ELSE concat('Camp #', CAST(l.l_partkey % 16 AS STRING)) END AS campaign,
  CASE WHEN l.l_discount < 0.005 THEN NULL WHEN l.l_discount < 0.035
    THEN ' NoPromotionApplied ' ELSE 'PromotionApplied' END AS promotion,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE concat(' ', p.p_brand, ' ') END AS promotionid,
  CAST(l.l_extendedprice * (1 - l.l_discount) AS DECIMAL(18,4)) AS novusd,
  CAST(l.l_extendedprice * (1 - l.l_discount) - l.l_quantity * p.p_retailprice
    AS DECIMAL(18,4)) AS contributionmargin,
  l.l_orderkey AS marketordernumber,
  CAST(l.l_extendedprice * l.l_tax AS DECIMAL(18,4)) AS shippingchargesusd,
  CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4)) AS promodiscountsusd,
  CAST(l.l_extendedprice AS DECIMAL(18,4)) AS grossprodpaymentorder,
  CAST(l.l_quantity AS INT) AS booksinorder,
  CASE WHEN o.o_custkey % 3 = 0 THEN 1 ELSE 0 END AS isreturningcustomer,
  p.p_type AS category, p.p_brand AS majorcategory, n.n_name AS country,
  CASE WHEN n.n_regionkey = 0 THEN 'Domestic' ELSE 'International' END
    AS orderdestinationtype,
  o.o_orderpriority AS medium,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE concat(
    CASE l.l_returnflag WHEN 'A' THEN 'Dynamic' WHEN 'N' THEN 'Static' ELSE 'Clearance' END,
    CASE WHEN l.l_linestatus = 'F' THEN 'Test' ELSE '' END) END AS pricingstrategy,
  p.p_name AS author
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey"""

VIEWS["ga_sessions_revenue"] = """
SELECT concat(lpad(CAST(month(ts) AS STRING), 2, '0'), '/',
    lpad(CAST(day(ts) AS STRING), 2, '0'), '/', CAST(year(ts) AS STRING)) AS date,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('/p', CAST(event_id % 5 AS STRING)) END
    AS landing_page,
  concat('ga-', CAST(event_id % 8 AS STRING)) AS campaign_name,
  concat('src', CAST(user_id % 12 AS STRING)) AS source,
  CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
    AS device_category,
  event_type AS medium, 1 + event_id % 3 AS sessions,
  CAST(value / 1000 AS DECIMAL(18,6)) AS bounce_rate, CAST(1 AS BIGINT) AS active_users,
  CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,4))
    ELSE CAST(0 AS DECIMAL(18,4)) END AS purchase_revenue
FROM events"""

VIEWS["google_ads_stats"] = """
SELECT CAST(CAST(l_shipdate AS DATE) AS STRING) AS date,
  concat('gads-', CAST(l_suppkey % 40 AS STRING)) AS campaign_name,
  CAST(l_quantity * 1000000 AS BIGINT) AS cost_micros,
  CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_extendedprice / 1000 END
    AS DECIMAL(18,6)) AS conversions_value,
  l_partkey % 500 AS impressions, l_partkey % 20 AS clicks, l_linenumber % 3 AS conversions
FROM lineitem"""

VIEWS["bing_ads_stats"] = """
SELECT CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END
    AS date,
  concat('bing-', CAST(l_suppkey % 30 AS STRING)) AS campaign_name,
  CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_extendedprice / 1000 END
    AS DECIMAL(18,6)) AS conversions_value,
  CAST(l_quantity AS DECIMAL(18,4)) AS spend,
  l_partkey % 400 AS impressions, l_partkey % 15 AS clicks, l_linenumber % 3 AS conversions
FROM lineitem WHERE l_returnflag = 'R'"""

VIEWS["facebook_ads_insights"] = """
SELECT CAST(CAST(ts AS DATE) AS STRING) AS date, CAST(user_id % 30 AS STRING) AS campaign_id,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(user_id % 7 AS STRING) END AS adset_id,
  CAST(user_id AS STRING) AS ad_id,
  CASE WHEN user_id % 30 = 29 THEN NULL ELSE concat('fb-', CAST(user_id % 30 AS STRING)) END
    AS campaign_name,
  SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,4))
    ELSE CAST(0 AS DECIMAL(18,4)) END) AS spend,
  CAST(SUM(CASE WHEN event_type = 'view' THEN 100 ELSE 0 END) AS BIGINT) AS impressions,
  CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks
FROM events WHERE event_type IN ('view', 'click') GROUP BY CAST(ts AS DATE), user_id"""

VIEWS["facebook_ads_actions"] = """
SELECT CAST(CAST(ts AS DATE) AS STRING) AS date, CAST(user_id % 30 AS STRING) AS campaign_id,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(user_id % 7 AS STRING) END AS adset_id,
  CAST(user_id AS STRING) AS ad_id,
  CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'omni_purchase'
    ELSE 'link_click' END AS action_type,
  CAST(value AS DECIMAL(18,4)) AS value
FROM events WHERE event_type IN ('purchase', 'signup', 'error')"""

VIEWS["affiliate_sales"] = """
SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS eventdate,
  o_orderkey - o_orderkey % 2 AS marketordernumber,
  concat('pub-', CAST(o_custkey % 60 AS STRING)) AS publishername,
  CAST(o_totalprice AS DECIMAL(18,4)) AS saleamountusd,
  CAST(o_totalprice * 0.07 AS DECIMAL(18,4)) AS publishercommissionusd,
  CAST(o_totalprice * 0.02 AS DECIMAL(18,4)) AS cjfeeusd,
  CAST(o_totalprice * 0.01 AS DECIMAL(18,4)) AS orderdiscountusd,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,4))
    ELSE CAST(0 AS DECIMAL(18,4)) END AS correctedamountusd
FROM orders"""

# -- scalar expressions ------------------------------------------------------------------


def monday(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


def tuesday(day: str) -> str:
    return f"CAST(date_trunc('week', {day} - INTERVAL 1 DAY) + INTERVAL 1 DAY AS DATE)"


def unified(col: str) -> str:
    s = f"rtrim(split_part(lower(trim({col})), '?', 1), '/')"

    def has(*needles: str) -> str:
        return " OR ".join(f"contains({s}, '{needle}')" for needle in needles)

    return f"""CASE WHEN {col} IS NULL OR trim({col}) = '' THEN 'unspecified'
    WHEN {has('betterworldbooks.com', 'betterworldbooks.zendesk.com', '(direct)')}
      THEN 'BetterWorldBooks'
    WHEN {has('facebook.com')} THEN 'Facebook'
    WHEN {has('google', 'g.doubleclick.net')} THEN 'Google'
    WHEN {has('bing')} THEN 'Bing'
    WHEN {has('yahoo')} THEN 'Yahoo'
    WHEN {has('duckduckgo')} THEN 'DuckDuckGo'
    WHEN {has('affiliate')} THEN 'Affiliate'
    WHEN {has('klaviyo')} THEN 'Klaviyo'
    WHEN {has('attentive')} THEN 'Attentive'
    WHEN {has('sendinblue')} THEN 'Sendinblue'
    WHEN {has('convertkit')} THEN 'ConvertKit'
    WHEN {has('cj_feed')} THEN 'CJ'
    WHEN {has('substack')} THEN 'Substack'
    WHEN {has('chatgpt')} THEN 'ChatGPT'
    WHEN {has('trustpilot')} THEN 'Trustpilot'
    WHEN {has('linkin.bio', 'later-linkinbio')} THEN 'Linkin.bio'
    WHEN {has('nps')} THEN 'NPS'
    ELSE {s} END"""


def campaign_of(col: str) -> str:
    words = r"\b(gclid|www\.google\.com|wwwgooglecom)\b"
    s = f"regexp_replace(lower(trim({col})), '{words}', 'google campaign', 'g')"
    s = rf"regexp_replace({s}, '[^\w\s]', '', 'g')"
    s = rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"
    return f"coalesce(nullif({s}, ''), 'unspecified')"


PROMO = """CASE WHEN promotion IS NULL OR trim(promotion) = 'NoPromotionApplied'
  THEN 'NoPromotion' ELSE coalesce(trim(promotionid), 'None') END"""


def ratio(num: str, den: str, name: str, scale: int = 1) -> str:
    times = f" * {scale}" if scale != 1 else ""
    return (
        f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE){times} "
        f"ELSE CAST(0 AS DOUBLE) END AS {name}"
    )


def money(col: str, name: str) -> str:
    return f"CAST(coalesce(SUM({col}), 0) AS DOUBLE) AS {name}"


def whole(col: str, name: str) -> str:
    return f"CAST(coalesce(SUM({col}), 0) AS BIGINT) AS {name}"


def average(col: str, name: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / nullif(COUNT({col}), 0) AS {name}"


def cards(*parts: str) -> str:
    return ",\n  ".join(parts)


# -- cleaned views -----------------------------------------------------------------------

VIEWS["sales"] = f"""
SELECT * EXCLUDE (campaign), CAST(orderdate AS DATE) AS order_ts,
  {monday('CAST(orderdate AS DATE)')} AS "Week",
  {unified('websource')} AS cleaned_websource,
  {campaign_of('campaign')} AS campaign,
  {PROMO} AS promo_clean,
  regexp_replace(pricingstrategy, 'Test$', '') AS strategy_base,
  ends_with(pricingstrategy, 'Test') AS is_test
FROM website_sales"""

VIEWS["sessions_clean"] = f"""
SELECT * EXCLUDE (landing_page), coalesce(landing_page, 'unspecified') AS landing_page,
  {tuesday("strptime(date, '%m/%d/%Y')")} AS "Week" FROM ga_sessions_revenue"""

VIEWS["google_clean"] = f"""
SELECT *, {tuesday('CAST(date AS DATE)')} AS "Week" FROM google_ads_stats"""

VIEWS["bing_clean"] = f"""
SELECT *, {monday('TRY_CAST(date AS DATE)')} AS "Week" FROM bing_ads_stats"""

VIEWS["affiliate_clean"] = f"""
SELECT *, {monday('TRY_CAST(eventdate AS DATE)')} AS "Week" FROM affiliate_sales"""

VIEWS["purchases"] = """
SELECT * FROM facebook_ads_actions WHERE action_type IN ('purchase', 'omni_purchase',
  'onsite_web_purchase', 'offsite_conversion.fb_pixel_purchase', 'onsite_web_app_purchase',
  'web_in_store_purchase')"""

VIEWS["ads_joined"] = f"""
SELECT i.date, i.campaign_id, coalesce(i.adset_id, 'None') AS adset_id, i.ad_id,
  i.campaign_name, i.spend, i.impressions, i.clicks, a.action_type, a.value,
  {monday('CAST(i.date AS DATE)')} AS "Week",
  CASE WHEN i.spend <> 0 AND a.value IS NOT NULL
    THEN CAST(a.value AS DOUBLE) / CAST(i.spend AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "ROI"
FROM facebook_ads_insights i LEFT JOIN purchases a
  ON concat(i.date, '_', coalesce(i.campaign_id, 'None'), '_', coalesce(i.adset_id, 'None'),
    '_', coalesce(i.ad_id, 'None'))
   = concat(a.date, '_', coalesce(a.campaign_id, 'None'), '_', coalesce(a.adset_id, 'None'),
    '_', coalesce(a.ad_id, 'None'))"""

# -- weekly tables -----------------------------------------------------------------------

REV = money("novusd", "Total_Revenue")
PRO = money("contributionmargin", "Total_Profit")
CNT = "COUNT(marketordernumber) AS Order_Count"
DIS = money("promodiscountsusd", "Total_Discount")
AOV = ratio("Total_Revenue", "Order_Count", "AOV")
MARGIN = ratio("Total_Profit", "Total_Revenue", "Profit_Margin", 100)
AVG_DIS = ratio("Total_Discount", "Order_Count", "Average_Discount_Amount")

ORDER_SUMS = cards(
    REV, PRO, CNT, money("shippingchargesusd", "Total_Shipping"), DIS,
    money("grossprodpaymentorder", "Gross_Order_Value"), whole("booksinorder", "Total_Books"),
    whole("isreturningcustomer", "Returning_Count"),
)
ORDER_RATIOS = cards(
    AOV, ratio("Total_Profit", "Order_Count", "Profit_Per_Order"), MARGIN,
    ratio("Total_Discount", "Gross_Order_Value", "Average_Discount_Percentage", 100), AVG_DIS,
    "Gross_Order_Value - Total_Revenue AS Gross_vs_Net_Difference",
    ratio("Returning_Count", "Order_Count", "Returning_Ratio", 100),
    ratio("Total_Books", "Order_Count", "Average_Order_Size"),
    ratio("Total_Shipping", "Order_Count", "Average_Shipping_Cost"),
)
AD_SUMS = cards(
    money("conversions_value", "conversions_value"), "{cost}",
    whole("impressions", "impressions"), whole("clicks", "clicks"),
    whole("conversions", "conversions"),
)
AD_RATIOS = cards(
    'conversions_value - cost AS "Profit"', ratio("conversions_value", "cost", '"ROI"'),
    ratio("clicks", "impressions", '"CTR"', 100),
    ratio("conversions", "clicks", "Conversion_Rate", 100), ratio("cost", "clicks", '"CPC"'),
    ratio("cost", "conversions", "Cost_Per_Conversion"),
    ratio("conversions_value", "conversions", "Avg_Revenue_Per_Conversion"),
    ratio("conversions_value", "clicks", "Avg_Revenue_Per_Click"),
)
SESSION_SUMS = cards(
    whole("sessions", "Total_Sessions"), average("bounce_rate", "Avg_Bounce_Rate"),
    whole("active_users", "Total_Active_Users"),
    money("purchase_revenue", "Total_Purchase_Revenue"),
)
SOCIAL_SUMS = cards(
    money("value", "revenue"), money("spend", "cost"), whole("impressions", "impressions"),
    whole("clicks", "clicks"),
)
SOCIAL_RATIOS = cards(
    'revenue - cost AS "Profit"', ratio("revenue", "cost", '"ROI"'),
    ratio("clicks", "impressions", '"CTR"', 100), ratio("cost", "clicks", '"CPC"'),
    ratio("revenue", "clicks", "Avg_Revenue_Per_Click"),
)


def grouped(
    view: str, keys: str, sums: str, ratios: str = "", checked: str | None = None
) -> str:
    """Grouped sums without NULL keys, then ratios over them."""
    names = keys if checked is None else checked
    where = " AND ".join(f"{k} IS NOT NULL" for k in names.split(", ") if k) or "TRUE"
    inner = f"SELECT {keys}, {sums} FROM {view} WHERE {where} GROUP BY {keys}"
    return f"SELECT *, {ratios} FROM ({inner})" if ratios else inner


def best(view: str, by: str, ties: str, where: str = "TRUE", n: int = 10) -> str:
    return f"""SELECT * FROM {view} WHERE "Week" IS NOT NULL AND {where}
QUALIFY row_number() OVER (PARTITION BY "Week" ORDER BY {by} DESC NULLS LAST, {ties}) <= {n}"""


W = '"Week"'
VIEWS["website_weekly_campaign"] = grouped("sales", f"{W}, campaign", ORDER_SUMS, ORDER_RATIOS)
VIEWS["website_weekly_top_campaign"] = best(
    "website_weekly_campaign", "Total_Profit", "campaign"
)
VIEWS["website_campaign_analysis"] = "SELECT * FROM website_weekly_campaign"
VIEWS["website_campaign_segmentation_analysis"] = grouped(
    "sales", f"{W}, campaign, cleaned_websource, category, isreturningcustomer",
    cards(REV, PRO, CNT), cards(AOV, MARGIN),
)
PROMO_SUMS = cards(
    money("novusd", "total_revenue"), money("contributionmargin", "total_profit"),
    "COUNT(marketordernumber) AS total_orders",
)
VIEWS["promo_weekly_metrics"] = grouped("sales", f"{W}, promo_clean", PROMO_SUMS)
VIEWS["website_promotion_top10_weekly"] = best(
    "promo_weekly_metrics", "total_profit", "promo_clean", "promo_clean <> 'NoPromotion'"
)
VIEWS["active_days"] = grouped(
    "sales", f"{W}, promo_clean", "COUNT(DISTINCT order_ts) AS days_active"
)
VIEWS["promo_daily_averages"] = """
SELECT p.*, d.days_active, total_revenue / days_active AS avg_daily_revenue,
  total_profit / days_active AS avg_daily_profit,
  CAST(total_orders AS DOUBLE) / days_active AS avg_daily_orders
FROM promo_weekly_metrics p LEFT JOIN active_days d USING ("Week", promo_clean)"""


def lift(name: str) -> str:
    x, b = f"t.avg_daily_{name}", f"b.avg_daily_{name}"
    return f"CASE WHEN {b} > 0 THEN ({x} - {b}) / {b} * 100 END AS {name}_lift"


VIEWS["website_promotion_daily_uplift_top10"] = f"""
SELECT k."Week", k.promo_clean, {lift('revenue')}, {lift('profit')}, {lift('orders')}
FROM website_promotion_top10_weekly k
LEFT JOIN promo_daily_averages t ON k."Week" = t."Week" AND k.promo_clean = t.promo_clean
LEFT JOIN promo_daily_averages b ON k."Week" = b."Week" AND b.promo_clean = 'NoPromotion'"""
VIEWS["promotion_segments"] = grouped(
    "sales", f"{W}, promo_clean, cleaned_websource, category, isreturningcustomer",
    cards(REV, PRO, CNT, DIS), cards(AOV, MARGIN, AVG_DIS),
)
VIEWS["website_promotion_analysis"] = best(
    "promotion_segments", "Total_Profit",
    "promo_clean, cleaned_websource, category, isreturningcustomer",
)
VIEWS["website_customer_analysis"] = grouped(
    "sales", f"{W}, isreturningcustomer", cards(REV, CNT)
)
VIEWS["website_geo_source_analysis"] = grouped(
    "sales", f"{W}, country, orderdestinationtype, cleaned_websource, medium", cards(REV, CNT)
)
VIEWS["website_websource_analysis"] = grouped(
    "sales", f"{W}, cleaned_websource",
    cards(REV, money("contributionmargin", "Total_Total"), CNT),
    cards(AOV, ratio("Total_Total", "Total_Revenue", "Profit_Margin", 100)),
)
VIEWS["promotion_strategy_segments"] = grouped(
    "sales", f"{W}, promo_clean, campaign, pricingstrategy, category",
    cards(REV, PRO, CNT, DIS), cards(MARGIN, AVG_DIS),
)
VIEWS["website_promotion_strategy_analysis"] = best(
    "promotion_strategy_segments", "Total_Profit",
    "promo_clean, campaign, pricingstrategy, category",
)
VIEWS["website_author_analysis"] = grouped(
    "sales", f"{W}, author", cards(REV, PRO, CNT, whole("booksinorder", "Total_Books")),
    cards(AOV, MARGIN),
)
VIEWS["website_top10_authors_by_profit_weekly"] = best(
    "website_author_analysis", "Total_Profit", "author"
)
VIEWS["website_category_analysis"] = grouped(
    "sales", f"{W}, majorcategory", cards(REV, PRO, CNT), cards(AOV, MARGIN)
)
VIEWS["pricing_test_counts"] = grouped("sales", "strategy_base, is_test", 'COUNT(*) AS "count"')
VIEWS["pricing_weeks"] = grouped(
    "sales", f"{W}, strategy_base, is_test", cards(REV, PRO, CNT), cards(AOV, MARGIN),
    "strategy_base, is_test",
)
VIEWS["website_pricing_strategy_analysis"] = """
SELECT * REPLACE (coalesce(concat(strftime("Week", '%Y-%m-%d') || '/',
  strftime("Week" + INTERVAL 6 DAY, '%Y-%m-%d')), 'NaT') AS "Week") FROM pricing_weeks"""
VIEWS["website_weekly_overall"] = grouped("sales", W, ORDER_SUMS, ORDER_RATIOS)

VIEWS["ga_weekly_aggregation"] = grouped("sessions_clean", W, SESSION_SUMS)
VIEWS["ga_weekly_dimensions"] = grouped(
    "sessions_clean", f"{W}, campaign_name, source, device_category, landing_page, medium",
    SESSION_SUMS,
)
VIEWS["ga_weekly_top_sources"] = best(
    "ga_weekly_dimensions", "Total_Purchase_Revenue",
    "campaign_name, source, device_category, landing_page, medium",
)

GOOGLE = AD_SUMS.format(cost="CAST(SUM(cost_micros) AS DOUBLE) / 1000000 AS cost")
BING = AD_SUMS.format(cost=money("spend", "cost"))
VIEWS["google_ads_weekly_overall"] = grouped("google_clean", W, GOOGLE, AD_RATIOS)
VIEWS["google_ads_weekly_campaign"] = grouped(
    "google_clean", f"{W}, campaign_name", GOOGLE, AD_RATIOS
)
VIEWS["google_ads_weekly_top_campaign"] = best(
    "google_ads_weekly_campaign", '"Profit"', "campaign_name"
)
VIEWS["bing_ads_weekly_overall"] = grouped("bing_clean", W, BING, AD_RATIOS)
VIEWS["bing_ads_weekly_campaign"] = grouped(
    "bing_clean", f"{W}, campaign_name", BING, AD_RATIOS
)
VIEWS["bing_ads_weekly_top_campaign"] = best(
    "bing_ads_weekly_campaign", '"Profit"', "campaign_name", '"Profit" IS NOT NULL'
)

VIEWS["fb_weekly_campaigns"] = f"""
SELECT "Week", campaign_name, {SOCIAL_SUMS}, ROUND(AVG("ROI"), 6) AS "ROI"
FROM ads_joined GROUP BY "Week", campaign_name"""
VIEWS["facebook_ads_top10_campaigns"] = best(
    "fb_weekly_campaigns", "revenue", "campaign_name NULLS LAST"
)
VIEWS["facebook_ads_weekly_campaign"] = grouped("ads_joined", W, SOCIAL_SUMS, SOCIAL_RATIOS)
VIEWS["facebook_ads_weekly_aggregated"] = grouped(
    "ads_joined", W,
    cards(
        money("value", "Total_Value"), money("spend", "Total_Spend"),
        whole("impressions", "Total_Impressions"), whole("clicks", "Total_Clicks"),
        'ROUND(AVG("ROI"), 6) AS Avg_ROI',
    ),
)

VIEWS["affiliate_sales_weekly_overall"] = grouped(
    "affiliate_clean", W,
    cards(
        "COUNT(DISTINCT marketordernumber) AS Order_Count",
        money("saleamountusd", "Total_Sales"),
        money("publishercommissionusd", "Total_Commission"), money("cjfeeusd", "Total_Fees"),
        money("orderdiscountusd", "Total_Discount"),
        money("correctedamountusd", "Corrected_Amount"),
    ),
    "Total_Sales - Total_Commission - Total_Fees AS Net_After_Commission",
)
VIEWS["affiliate_sales_weekly_publisher"] = grouped(
    "affiliate_clean", f"{W}, publishername",
    cards(
        "COUNT(DISTINCT marketordernumber) AS Order_Count",
        money("saleamountusd", "Total_Sales"),
        money("publishercommissionusd", "Total_Commission"),
    ),
    "Total_Sales - Total_Commission AS Net_After_Commission",
)
VIEWS["affiliate_sales_weekly_top_publisher"] = best(
    "affiliate_sales_weekly_publisher", "Net_After_Commission", "publishername"
)

# -- statements --------------------------------------------------------------------------

SOURCES = {
    "website_sales": "novusd contributionmargin shippingchargesusd promodiscountsusd "
    "grossprodpaymentorder",
    "ga_sessions_revenue": "bounce_rate purchase_revenue",
    "google_ads_stats": "conversions_value",
    "facebook_ads_insights": "spend",
    "facebook_ads_actions": "value",
    "bing_ads_stats": "conversions_value spend",
    "affiliate_sales": "saleamountusd publishercommissionusd cjfeeusd orderdiscountusd "
    "correctedamountusd",
}
WEEKLY = (
    "website_weekly_campaign website_weekly_top_campaign website_campaign_analysis "
    "website_campaign_segmentation_analysis promo_weekly_metrics "
    "website_promotion_top10_weekly promo_daily_averages "
    "website_promotion_daily_uplift_top10 promotion_segments website_promotion_analysis "
    "website_customer_analysis website_geo_source_analysis website_websource_analysis "
    "promotion_strategy_segments website_promotion_strategy_analysis "
    "website_author_analysis website_top10_authors_by_profit_weekly "
    "website_category_analysis pricing_test_counts website_pricing_strategy_analysis "
    "website_weekly_overall ga_weekly_aggregation ga_weekly_dimensions "
    "ga_weekly_top_sources google_ads_weekly_overall google_ads_weekly_campaign "
    "google_ads_weekly_top_campaign bing_ads_weekly_overall bing_ads_weekly_campaign "
    "bing_ads_weekly_top_campaign fb_weekly_campaigns facebook_ads_top10_campaigns "
    "facebook_ads_weekly_campaign facebook_ads_weekly_aggregated "
    "affiliate_sales_weekly_overall affiliate_sales_weekly_publisher "
    "affiliate_sales_weekly_top_publisher"
).split()
OUTPUTS = [
    name
    for name in WEEKLY
    if name
    not in (
        "promo_weekly_metrics", "promo_daily_averages", "promotion_segments",
        "promotion_strategy_segments", "pricing_test_counts", "ga_weekly_dimensions",
        "fb_weekly_campaigns",
    )
]
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
PROMOTIONS = (*(f"Brand#{i}" for i in range(1, 26)), "None")
CORR = ("Total_Revenue", "Total_Profit", "Order_Count", "Total_Shipping", "Total_Discount")
WEEKLY_NUMBERS = (
    *CORR, "Gross_Order_Value", "Total_Books", "Returning_Count", "AOV", "Profit_Margin",
    "Profit_Per_Order", "Average_Discount_Percentage", "Average_Discount_Amount",
    "Gross_vs_Net_Difference", "Returning_Ratio", "Average_Order_Size", "Average_Shipping_Cost",
)
MEASURED = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)


def rsum(digits: int, *columns: str) -> str:
    return cards(*(f"ROUND(SUM({c}), {digits}) AS {c}" for c in columns))


def isum(*columns: str) -> str:
    return cards(*(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in columns))


def since(view: str, days: int | None) -> str:
    first = 'min("Week")' if days is None else f'max("Week") - INTERVAL {days} DAY'
    return f"""SELECT * FROM {view} WHERE "Week" BETWEEN
  (SELECT {first} FROM website_weekly_overall)
  AND (SELECT max("Week") FROM website_weekly_overall)"""


def top(view: str, key: str, sums: str, by: str) -> str:
    return f"""SELECT {key}, {sums} FROM {view} WHERE {key} IS NOT NULL GROUP BY {key}
ORDER BY SUM({by}) DESC NULLS LAST, {key} LIMIT 10"""


def pivoted(how: str, row: str, rounding: str = "{}", where: str = "TRUE") -> str:
    cells = cards(
        *(
            rounding.format(f"{how}(CASE WHEN category = '{c}' THEN Total_Revenue END)")
            + f' AS "{c}"'
            for c in CATEGORIES
        )
    )
    return f"SELECT {row}, {cells} FROM website_campaign_segmentation_analysis WHERE {where} GROUP BY {row}"


def described(view: str, columns: tuple[str, ...], digits: int) -> str:
    parts = []
    for c in columns:
        quartiles = cards(
            *(
                f"ROUND(quantile_cont(CAST({c} AS DOUBLE), {q}), {digits}) AS p{int(q * 100)}"
                for q in (0.25, 0.5, 0.75)
            )
        )
        parts.append(f"""SELECT '{c}' AS variable, COUNT({c}) AS "count",
  ROUND(AVG({c}), {digits}) AS mean, ROUND(stddev_samp({c}), {digits}) AS std,
  ROUND(CAST(MIN({c}) AS DOUBLE), {digits}) AS min, {quartiles},
  ROUND(CAST(MAX({c}) AS DOUBLE), {digits}) AS max FROM {view}""")
    return "\nUNION ALL\n".join(parts)


def matrix(value, view: str = "website_weekly_overall") -> str:
    rows = []
    for a in CORR:
        cells = cards(*(f"ROUND({value(a, b)}, 6) AS {b}" for b in CORR))
        rows.append(f"SELECT '{a}' AS index, {cells} FROM {view}")
    return "\nUNION ALL\n".join(rows)


VIEWS["ranked"] = "SELECT " + cards(
    *(
        f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
        for c in CORR
    )
) + " FROM website_weekly_overall"
VIEWS["couples"] = "SELECT " + cards(
    *(f"sign(p.{c} - q.{c}) AS {c}" for c in CORR)
) + ' FROM website_weekly_overall p JOIN website_weekly_overall q ON p."Week" < q."Week"'


def tau(a: str, b: str) -> str:
    return f"SUM({a} * {b}) / (sqrt(SUM({a} * {a})) * sqrt(SUM({b} * {b})))"


STATEMENTS: dict[str, str] = {f"scan_{t}": (
    f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in cols.split())}) "
    f"FROM {t}"
) for t, cols in SOURCES.items()}
STATEMENTS |= {name: f"SELECT * FROM {name}" for name in WEEKLY}
STATEMENTS |= {
    "website_promotion_daily_uplift_top10_tidy":
        "SELECT * FROM website_promotion_daily_uplift_top10",
    "dataset_bing_ads": "SELECT * FROM bing_ads_weekly_overall",
    "sink_roundtrip": "SELECT * FROM website_weekly_overall",
    "batch_outputs": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in OUTPUTS
    ),
    "load_week_normalised":
        'SELECT * REPLACE (CAST("Week" AS TIMESTAMP) AS "Week") FROM pricing_weeks',
    "preview": 'SELECT * FROM website_weekly_overall ORDER BY "Week" LIMIT 10',
    # calendar and text
    "week_start": f"SELECT o_orderkey, {monday('o_orderdate')} AS \"Week\" FROM orders",
    "week_start_tue": f"SELECT o_orderkey, {tuesday('o_orderdate')} AS \"Week\" FROM orders",
    "week_start_keep_time":
        'SELECT event_id, ts - to_days(CAST(isodow(ts) - 1 AS INT)) AS "Week" FROM events',
    "week_period_label": f"""SELECT o_orderkey, strftime({monday('o_orderdate')}, '%Y-%m-%d')
  || '/' || strftime({monday('o_orderdate')} + INTERVAL 6 DAY, '%Y-%m-%d') AS label
FROM orders""",
    "parse_dates": """SELECT date, TRY_CAST(date AS DATE) AS day, campaign_name
FROM bing_ads_stats""",
    "unify_source":
        "SELECT marketordernumber, websource, cleaned_websource FROM sales",
    "unify_page_source": f"SELECT page_id, {unified('url')} AS channel FROM pages",
    "clean_campaign": f"""SELECT marketordernumber, campaign AS raw,
  {campaign_of('campaign')} AS campaign FROM website_sales""",
    "promo_label": "SELECT marketordernumber, promotion, promotionid, promo_clean FROM sales",
    "pricing_base":
        "SELECT marketordernumber, pricingstrategy, strategy_base, is_test FROM sales",
    "ads_cost_from_micros": """SELECT date, campaign_name,
  CAST(cost_micros AS DOUBLE) / 1000000 AS cost FROM google_ads_stats""",
    # social ads
    "fb_key": """SELECT concat(date, '_', campaign_id, '_', coalesce(adset_id, 'None'), '_',
  ad_id) AS primary_key, clicks FROM facebook_ads_insights""",
    "fb_purchase_actions": "SELECT * REPLACE (CAST(value AS DOUBLE) AS value) FROM purchases",
    "fb_joined": """SELECT date, campaign_id, adset_id, ad_id, campaign_name,
  CAST(spend AS DOUBLE) AS spend, impressions, clicks, action_type,
  CAST(value AS DOUBLE) AS value, "ROI" FROM ads_joined""",
    "fb_joined_preagg": """SELECT * EXCLUDE (value), CAST(value AS DOUBLE) AS value,
  CASE WHEN spend <> 0 AND value IS NOT NULL
    THEN CAST(value AS DOUBLE) / spend ELSE CAST(0 AS DOUBLE) END AS "ROI"
FROM (SELECT date, campaign_id, adset_id, ad_id, campaign_name,
    CAST(spend AS DOUBLE) AS spend, impressions, clicks, SUM(value) AS value
  FROM ads_joined GROUP BY ALL)""",
    # week ranges
    "filter_week_range": """SELECT * FROM website_weekly_overall
WHERE "Week" BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
    "last_7_days": since("website_weekly_overall", 7),
    "last_28_days": since("website_weekly_overall", 28),
    "last_90_days": since("website_weekly_overall", 90),
    "last_365_days": since("website_weekly_overall", 365),
    "lifetime": since("website_weekly_overall", None),
    "last_90_days_google_ads": since("google_ads_weekly_overall", 90),
    "website_wow_series": """SELECT "Week", Total_Revenue,
  lag(Total_Revenue) OVER w AS Prev_Revenue,
  Total_Revenue - lag(Total_Revenue) OVER w AS Revenue_Change
FROM website_weekly_overall WINDOW w AS (ORDER BY "Week")""",
    "website_wow": """SELECT "Week", Total_Revenue, Prev_Revenue,
  Total_Revenue - Prev_Revenue AS Revenue_Change,
  CASE WHEN Prev_Revenue <> 0 THEN Total_Revenue - Prev_Revenue ELSE 0 END AS diff,
  CASE WHEN Prev_Revenue <> 0 THEN (Total_Revenue - Prev_Revenue) / Prev_Revenue * 100
    ELSE 0 END AS pct
FROM (SELECT *, lag(Total_Revenue) OVER (ORDER BY "Week") AS Prev_Revenue
  FROM website_weekly_overall) ORDER BY "Week" DESC LIMIT 1""",
    "google_ads_wow": """SELECT "Week", "Profit", Prev_Profit,
  "Profit" - Prev_Profit AS Profit_Change, "Profit" - Prev_Profit AS diff,
  CASE WHEN Prev_Profit = 0 THEN 0 ELSE ("Profit" - Prev_Profit) / Prev_Profit * 100 END AS pct
FROM (SELECT *, lag("Profit") OVER (ORDER BY "Week") AS Prev_Profit
  FROM google_ads_weekly_overall) ORDER BY "Week" DESC LIMIT 1""",
    "ga_weekly_monday": grouped(
        "(SELECT * REPLACE (" + monday("strptime(date, '%m/%d/%Y')")
        + ' AS "Week") FROM sessions_clean)', W, SESSION_SUMS
    ),
    # cards
    "kpi_website": """SELECT ROUND(SUM(Total_Revenue), 4) AS total_revenue,
  ROUND(SUM(Total_Profit), 4) AS total_profit, ROUND(AVG(Profit_Margin), 4) AS avg_margin,
  ROUND(AVG("AOV"), 4) AS avg_aov FROM website_weekly_overall""",
    "kpi_website_weighted": """SELECT ROUND(SUM(Total_Revenue), 4) AS total_revenue,
  ROUND(SUM(Total_Profit), 4) AS total_profit, CAST(SUM(Order_Count) AS BIGINT) AS order_count,
  ROUND(SUM(Total_Profit) / SUM(Total_Revenue) * 100, 4) AS margin,
  ROUND(SUM(Total_Revenue) / SUM(Order_Count), 4) AS aov FROM website_weekly_overall""",
    "kpi_facebook": """SELECT ROUND(revenue, 4) AS revenue, ROUND(cost, 4) AS cost,
  impressions, clicks, ROUND(revenue - cost, 4) AS profit,
  ROUND(CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / impressions * 100 ELSE 0 END, 4)
    AS ctr_pct,
  ROUND(CASE WHEN clicks > 0 THEN cost / clicks ELSE 0 END, 4) AS cpc,
  ROUND(CASE WHEN cost > 0 THEN revenue / cost * 100 ELSE 0 END, 4) AS revenue_pct
FROM (SELECT SUM(revenue) AS revenue, SUM(cost) AS cost,
  CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks
  FROM facebook_ads_weekly_campaign)""",
    "kpi_ga": """SELECT CAST(SUM(Total_Sessions) AS BIGINT) AS sessions,
  ROUND(SUM(Total_Purchase_Revenue), 4) AS revenue, ROUND(AVG(Avg_Bounce_Rate), 6) AS avg_bounce
FROM ga_weekly_aggregation""",
    "kpi_google_ads": """SELECT ROUND(SUM(cost), 5) AS cost,
  ROUND(SUM(conversions_value), 5) AS revenue,
  ROUND(SUM(conversions_value) - SUM(cost), 5) AS profit,
  ROUND((SUM(conversions_value) - SUM(cost)) / SUM(cost) * 100, 5) AS profit_pct,
  ROUND(CAST(SUM(clicks) AS DOUBLE) / SUM(impressions) * 100, 5) AS ctr_pct,
  ROUND(SUM(cost) / SUM(clicks), 5) AS cpc, ROUND(SUM("Profit"), 5) AS total_profit,
  ROUND(AVG("ROI") * 100, 5) AS avg_roi_pct FROM google_ads_weekly_overall""",
    "kpi_bing": """SELECT ROUND(SUM(cost), 5) AS cost,
  ROUND(SUM(conversions_value), 5) AS revenue,
  ROUND(SUM(conversions_value) - SUM(cost), 5) AS profit,
  ROUND(SUM(conversions_value) / SUM(cost) * 100, 5) AS revenue_pct,
  ROUND(CAST(SUM(clicks) AS DOUBLE) / SUM(impressions) * 100, 5) AS ctr_pct,
  ROUND(SUM(cost) / SUM(clicks), 5) AS cpc, CAST(SUM(conversions) AS BIGINT) AS conversions,
  CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
  ROUND(SUM("Profit"), 5) AS total_profit, ROUND(AVG("ROI") * 100, 5) AS avg_roi_pct,
  ROUND(AVG("CTR"), 5) AS avg_ctr FROM bing_ads_weekly_overall""",
    "kpi_affiliate": """SELECT ROUND(SUM(Total_Sales), 4) AS sales,
  ROUND(SUM(Total_Commission), 4) AS commission, ROUND(SUM(Net_After_Commission), 4) AS net,
  CAST(SUM(Order_Count) AS BIGINT) AS orders, ROUND(SUM(Total_Fees), 4) AS fees,
  ROUND(SUM(Total_Discount), 4) AS discount,
  ROUND(SUM(Total_Commission) / SUM(Order_Count), 4) AS avg_commission,
  ROUND(SUM(Total_Sales) / SUM(Order_Count), 4) AS avg_sales,
  ROUND(SUM(Net_After_Commission) / SUM(Order_Count), 4) AS avg_net
FROM affiliate_sales_weekly_overall""",
    "affiliate_distinct_orders":
        "SELECT COUNT(DISTINCT marketordernumber) AS orders FROM affiliate_sales",
    "profit_by_platform": """SELECT 'Bing Ads' AS "Platform",
  ROUND(coalesce(SUM(conversions_value) - SUM(cost), 0), 4) AS "Profit"
  FROM bing_ads_weekly_overall
UNION ALL SELECT 'Facebook Ads', ROUND(coalesce(SUM(revenue) - SUM(cost), 0), 4)
  FROM facebook_ads_weekly_campaign
UNION ALL SELECT 'Google Ads', ROUND(coalesce(SUM(conversions_value) - SUM(cost), 0), 4)
  FROM google_ads_weekly_overall""",
    # reports
    "affiliate_share": """SELECT *, ROUND(Total_Sales / (SELECT SUM(Total_Sales)
  FROM affiliate_sales_weekly_publisher) * 100, 8) AS Percent_of_Total
FROM affiliate_sales_weekly_publisher
ORDER BY Total_Sales DESC, "Week", publishername LIMIT 10""",
    "top10_campaigns_by_revenue": top(
        "website_weekly_top_campaign", "campaign", rsum(4, "Total_Revenue", "Total_Profit"),
        "Total_Revenue",
    ),
    "overall_top_campaigns": top(
        "website_weekly_top_campaign", "campaign",
        cards(
            rsum(4, "Total_Profit", "Total_Revenue"), isum("Order_Count"),
            "ROUND(AVG(Profit_Margin), 4) AS Profit_Margin",
        ),
        "Total_Profit",
    ),
    "websource_top10_trend": """SELECT * FROM website_websource_analysis
WHERE cleaned_websource IN (SELECT cleaned_websource FROM website_websource_analysis
  GROUP BY 1 ORDER BY SUM(Total_Revenue) DESC, 1 LIMIT 10)""",
    "pricing_top10_trend": """SELECT * REPLACE (CAST("Week" AS TIMESTAMP) AS "Week")
FROM pricing_weeks WHERE strategy_base IN (SELECT strategy_base FROM pricing_weeks
  GROUP BY 1 ORDER BY SUM(Total_Revenue) DESC, 1 LIMIT 10)""",
    "promo_global_top10": top(
        "website_promotion_top10_weekly", "promo_clean",
        cards(rsum(4, "total_profit", "total_revenue"), isum("total_orders")), "total_profit",
    ),
    "promo_uplift_top10": """SELECT promo_clean, ROUND(AVG(revenue_lift), 4) AS revenue_lift,
  ROUND(AVG(profit_lift), 4) AS profit_lift, ROUND(AVG(orders_lift), 4) AS orders_lift
FROM website_promotion_daily_uplift_top10 GROUP BY promo_clean
ORDER BY AVG(revenue_lift) DESC NULLS LAST, promo_clean LIMIT 10""",
    "promo_pivot_uplift": (
        'SELECT "Week", '
        + cards(*(
            f'"{b}", CASE WHEN "NoPromotion" <> 0 THEN ("{b}" - "NoPromotion") / "NoPromotion" '
            f'END AS "{b}_uplift"' for b in PROMOTIONS
        ))
        + ', "NoPromotion" FROM (SELECT "Week", '
        + cards(*(
            f"SUM(CASE WHEN promo_clean = '{b}' THEN total_revenue END) AS \"{b}\""
            for b in ("NoPromotion", *PROMOTIONS)
        ))
        + ' FROM promo_weekly_metrics GROUP BY "Week")'
    ),
    "best_strategy_combo": """SELECT * FROM website_promotion_strategy_analysis
ORDER BY Total_Profit DESC NULLS LAST, Profit_Margin DESC NULLS LAST, "Week", promo_clean,
  campaign, pricingstrategy, category LIMIT 5""",
    "authors_top10": top(
        "website_top10_authors_by_profit_weekly", "author", rsum(4, "Total_Revenue"),
        "Total_Revenue",
    ),
    "author_list": """SELECT DISTINCT author FROM website_top10_authors_by_profit_weekly
ORDER BY author""",
    "author_report": """SELECT author, CAST(SUM(Total_Books) AS BIGINT) AS total_books,
  ROUND(SUM(Total_Revenue), 4) AS total_revenue, ROUND(SUM(Total_Profit), 4) AS total_profit
FROM website_top10_authors_by_profit_weekly WHERE author = 'red widget' GROUP BY author""",
    "author_trend": """SELECT "Week", Total_Revenue, Total_Profit, Total_Books
FROM website_top10_authors_by_profit_weekly WHERE author = 'red widget' ORDER BY "Week\"""",
    "ga_top_sources_period": top(
        "ga_weekly_top_sources", "source",
        cards(rsum(4, "Total_Purchase_Revenue"), isum("Total_Sessions")),
        "Total_Purchase_Revenue",
    ),
    "fb_weekly_ratios": f"""SELECT "Week", revenue, cost, impressions, clicks, {SOCIAL_RATIOS}
FROM facebook_ads_weekly_campaign""",
    "fb_period_totals": """SELECT ROUND(SUM(revenue), 4) AS total_revenue,
  ROUND(SUM(cost), 4) AS total_cost, ROUND(SUM(revenue) - SUM(cost), 4) AS total_profit,
  ROUND(CASE WHEN SUM(cost) > 0 THEN SUM(revenue) / SUM(cost) ELSE 0 END, 4) AS overall_roi
FROM facebook_ads_weekly_campaign""",
    "fb_top10_period": """SELECT campaign_name, ROUND(SUM(revenue), 4) AS revenue,
  ROUND(SUM(cost), 4) AS cost, ROUND(SUM(revenue) - SUM(cost), 4) AS "Profit"
FROM facebook_ads_top10_campaigns WHERE campaign_name IS NOT NULL GROUP BY campaign_name
ORDER BY SUM(revenue) - SUM(cost) DESC, campaign_name LIMIT 10""",
    "bing_top10_period": top(
        "bing_ads_weekly_campaign", "campaign_name",
        cards(
            rsum(5, '"Profit"', "conversions_value"), isum("clicks", "impressions"),
            'ROUND(AVG("ROI"), 5) AS "ROI"',
        ),
        '"Profit"',
    ),
    "affiliate_daily": """SELECT "Week" AS "Date", ROUND(SUM(Total_Sales), 4) AS Total_Sales
FROM affiliate_sales_weekly_overall GROUP BY "Week\"""",
    "affiliate_top10_period": top(
        "affiliate_sales_weekly_publisher", "publishername",
        cards(
            rsum(4, "Total_Sales", "Total_Commission", "Net_After_Commission"),
            isum("Order_Count"),
        ),
        "Total_Sales",
    ),
    "weekly_trend": """SELECT "Week", Total_Revenue, Total_Profit, Order_Count, "AOV",
  Profit_Margin FROM website_weekly_overall ORDER BY "Week\"""",
    "weekly_trend_ga": """SELECT "Week", Total_Purchase_Revenue, Total_Sessions,
  Avg_Bounce_Rate FROM ga_weekly_aggregation ORDER BY "Week\"""",
    "weekly_trend_google_ads": """SELECT "Week", "Profit", "ROI"
FROM google_ads_weekly_overall ORDER BY "Week\"""",
    "weekly_trend_facebook": """SELECT "Week", cost, revenue, "ROI"
FROM facebook_ads_weekly_campaign ORDER BY "Week\"""",
    "weekly_trend_bing": """SELECT "Week", clicks, cost, "Profit", "ROI", "CTR"
FROM bing_ads_weekly_overall ORDER BY "Week\"""",
    # exploration
    "describe_numeric": described("lineitem", MEASURED, 4),
    "describe_weekly": described("website_weekly_overall", WEEKLY_NUMBERS, 4),
    "describe_week": """SELECT 'Week' AS variable, COUNT("Week") AS "count",
  make_timestamp(CAST(ROUND(AVG(us)) AS BIGINT)) AS mean,
  make_timestamp(CAST(MIN(us) AS BIGINT)) AS min,
  make_timestamp(CAST(ROUND(quantile_cont(us, 0.25)) AS BIGINT)) AS p25,
  make_timestamp(CAST(ROUND(quantile_cont(us, 0.5)) AS BIGINT)) AS p50,
  make_timestamp(CAST(ROUND(quantile_cont(us, 0.75)) AS BIGINT)) AS p75,
  make_timestamp(CAST(MAX(us) AS BIGINT)) AS max
FROM (SELECT "Week", CAST(epoch_us(CAST("Week" AS TIMESTAMP)) AS DOUBLE) AS us
  FROM website_weekly_overall)""",
    "corr_pearson": matrix(lambda a, b: f"corr({a}, {b})"),
    "corr_spearman": matrix(lambda a, b: f"corr({a}, {b})", "ranked"),
    "corr_kendall": matrix(tau, "couples"),
    "corr_long": "\nUNION ALL\n".join(
        f"SELECT '{a}' AS index, '{b}' AS variable, ROUND(corr({a}, {b}), 6) AS value "
        "FROM website_weekly_overall"
        for a in CORR
        for b in CORR
    ),
    "pivot_sum": pivoted("SUM", "campaign", "ROUND({}, 4)"),
    "pivot_mean": pivoted("AVG", "campaign", "ROUND({}, 4)"),
    "pivot_max": pivoted("MAX", "campaign"),
    "pivot_min": pivoted("MIN", "campaign"),
    "pivot_same_axis": pivoted("SUM", "category", "ROUND({}, 4)"),
    "filter_contains": """SELECT * FROM website_campaign_segmentation_analysis
WHERE regexp_matches(cleaned_websource, 'goo|FACE', 'i')""",
    "pivot_contains": pivoted(
        "SUM", "campaign", "ROUND({}, 4)", "regexp_matches(cleaned_websource, 'goo|FACE', 'i')"
    ),
    "xy_series":
        'SELECT "Week", Order_Count, Total_Revenue FROM website_weekly_overall',
    "scatter_matrix_pairs": "\nUNION ALL\n".join(
        f"""SELECT "Week", '{a}' AS x_var, '{b}' AS y_var, CAST({a} AS DOUBLE) AS x,
  CAST({b} AS DOUBLE) AS y FROM website_weekly_overall"""
        for a in CORR[:4]
        for b in CORR[:4]
    ),
    "forecast_trend": """
WITH points AS (SELECT CAST(epoch(CAST("Week" AS TIMESTAMP)) / 86400 AS DOUBLE) AS t,
    Total_Profit AS y, "Week" AS ds FROM website_weekly_overall),
  line AS (SELECT regr_slope(y, t) AS b, AVG(y) AS my, AVG(t) AS mt, MAX(ds) AS last_day,
    sqrt((regr_syy(y, t) - regr_slope(y, t) * regr_sxy(y, t)) / (COUNT(*) - 2)) AS s
    FROM points),
  grid AS (SELECT ds FROM points UNION ALL
    SELECT CAST(last_day + to_days(CAST(i AS INT)) AS DATE) FROM line, range(1, 31) r(i))
SELECT ds, ROUND(yhat, 2) AS yhat, ROUND(yhat - 1.2815515655446004 * s, 2) AS yhat_lower,
  ROUND(yhat + 1.2815515655446004 * s, 2) AS yhat_upper
FROM (SELECT grid.ds, s, my + b * (epoch(CAST(grid.ds AS TIMESTAMP)) / 86400 - mt) AS yhat
  FROM grid, line)""",
}


# -- distinct orders over a range ----------------------------------------------------------

for _preset, _days in (("7_days", 7), ("28_days", 28), ("90_days", 90), ("365_days", 365), (None, None)):
    _name = f"last_{_preset}" if _preset else "lifetime"
    STATEMENTS[f"affiliate_distinct_orders_{_name}"] = f"""
SELECT COUNT(DISTINCT marketordernumber) AS orders FROM ({since("affiliate_clean", _days)})"""


# -- additive forecasts -------------------------------------------------------------------


def additive(view: str, y: str, horizon: int, key: str | None, digits: int) -> str:
    """The additive forecast as normal equations, solved by elimination in a recursive query.

    Columns of the design: 1, the time from 0 to 1, 25 bends, 10 yearly and 3 weekly waves as sine and
    cosine.  Columns a series doesn't use are 0, and the penalty on them keeps them out of the solution.
    """
    series = key or "'all'"
    size = 2 + 25 + 2 * 10 + 2 * 3
    tau = "2 * pi()"
    waves = lambda n, days, use: f"""flatten(list_transform(range(1, {n + 1}), lambda k:
      [CASE WHEN {use} THEN sin({tau} * k * day / {days}) ELSE 0 END,
       CASE WHEN {use} THEN cos({tau} * k * day / {days}) ELSE 0 END]))"""  # noqa: E731
    part = lambda first, last: f"""scale * list_sum(list_transform(list_zip(x[{first}:{last}], beta[{first}:{last}]),
      lambda z: z[1] * z[2]))"""  # noqa: E731
    design = lambda table: f"""SELECT {table}.*, scale, bends, greatest(t - 1, 0) AS ahead,
      list_concat(list_concat([1.0, t], list_transform(range(1, 26), lambda j:
        CASE WHEN j <= bends THEN greatest(t - 0.8 * j / bends, 0) ELSE 0 END)),
        list_concat({waves(10, 365.25, "yearly")}, {waves(3, 7.0, "weekly")})) AS x
    FROM (SELECT {table}.*, (day - first_day) / span AS t FROM {table} JOIN facts USING (series)) {table}
    JOIN facts USING (series)"""  # noqa: E731
    shown = [f"{key}, " if key else "", "ds"]
    numbers = ["yhat", "yhat_lower", "yhat_upper", *(["trend", "yearly", "weekly"] if key else [])]
    return f"""WITH RECURSIVE days AS (
  SELECT {series} AS series, CAST(epoch(CAST("Week" AS TIMESTAMP)) / 86400 AS BIGINT) AS day, COUNT(*) AS n,
    AVG(CAST({y} AS DOUBLE)) AS mean, SUM(CAST({y} AS DOUBLE) * {y}) AS squares
  FROM {view} WHERE "Week" IS NOT NULL AND {y} IS NOT NULL GROUP BY ALL
), gaps AS (SELECT *, day - lag(day) OVER (PARTITION BY series ORDER BY day) AS gap FROM days
), facts AS (
  SELECT *, span >= 2 * 365.25 AS yearly, spacing < 7 AND span >= 14 AS weekly FROM (
    SELECT series, MIN(day) AS first_day, MAX(day) AS last_day, greatest(MAX(day) - MIN(day), 1) AS span,
      CASE WHEN MAX(abs(mean)) > 0 THEN MAX(abs(mean)) ELSE 1 END AS scale, coalesce(MIN(gap), 7) AS spacing,
      least(25, greatest(CAST(floor(COUNT(*) * 0.8) AS BIGINT) - 1, 0)) AS bends FROM gaps GROUP BY series)
), known AS (
  SELECT *, mean / scale AS target FROM ({design("days")})
), line AS (
  SELECT series, b, my - b * mt AS a FROM (
    SELECT series, SUM(n * target) / SUM(n) AS my, SUM(n * x[2]) / SUM(n) AS mt,
      (SUM(n * x[2] * target) - SUM(n * x[2]) * SUM(n * target) / SUM(n))
      / (SUM(n * x[2] * x[2]) - SUM(n * x[2]) * SUM(n * x[2]) / SUM(n)) AS b FROM known GROUP BY series)
), noise AS (
  SELECT series, greatest(SUM(n * (target - a - b * x[2]) ** 2) / SUM(n), 1e-9) AS noise
  FROM known JOIN line USING (series) GROUP BY series
), cells AS (
  SELECT series, i, j, SUM(n * x[i] * CASE WHEN j <= {size} THEN x[j] ELSE target END) AS v
  FROM known, range(1, {size + 1}) r(i), range(1, {size + 2}) c(j) GROUP BY series, i, j
), system AS (
  SELECT series, i, list(v + CASE WHEN i <> j OR i <= 2 THEN 0 WHEN i <= 27 THEN noise / 0.0025
    ELSE noise / 100 END ORDER BY j) AS line FROM cells JOIN noise USING (series) GROUP BY series, i
), solving AS (
  SELECT 1 AS k, series, i, line FROM system
  UNION ALL
  SELECT k + 1, series, i, CASE WHEN i = k THEN list_transform(line, lambda v: v / line[k])
    ELSE list_transform(list_zip(line, chosen), lambda z: z[1] - line[k] / chosen[k] * z[2]) END
  FROM (SELECT *, MAX(CASE WHEN i = k THEN line END) OVER (PARTITION BY series) AS chosen FROM solving WHERE k <= {size})
), solved AS (
  SELECT series, list(line[{size + 1}] ORDER BY i) AS beta FROM solving WHERE k = {size + 1} GROUP BY series
), spread AS (
  SELECT series, SUM(n * (target - list_sum(list_transform(list_zip(x, beta), lambda z: z[1] * z[2]))) ** 2
      + greatest(squares - n * mean * mean, 0) / scale ** 2) / SUM(n) AS sigma2,
    CASE WHEN any_value(bends) = 0 THEN 0 ELSE list_sum(list_transform(any_value(beta)[3:27], lambda v: abs(v)))
      / any_value(bends) END AS bend
  FROM known JOIN solved USING (series) GROUP BY series
), grid AS (
  SELECT series, day FROM days
  UNION ALL SELECT series, last_day + i FROM facts, range(1, {horizon + 1}) r(i)
), parts AS (
  SELECT series AS {key or "_series"}, CAST(to_timestamp(day * 86400) AT TIME ZONE 'UTC' AS DATE) AS ds,
    {part(1, 27)} AS trend, {part(28, 47)} AS yearly, {part(48, size)} AS weekly,
    1.2815515655446004 * scale * sqrt(sigma2 + 2 * bends * bend ** 2 * ahead ** 3 / 3) AS half
  FROM ({design("grid")}) JOIN solved USING (series) JOIN spread USING (series)
)
SELECT {"".join(shown)}, {", ".join(f"ROUND({n}, {digits}) + 0.0 AS {n}" for n in numbers)}
FROM (SELECT *, trend + yearly + weekly AS yhat, yhat - half AS yhat_lower, yhat + half AS yhat_upper FROM parts)"""


FORECAST_DIGITS = 1
STATEMENTS |= {
    "forecast_additive": additive("website_weekly_overall", "Total_Profit", 30, None, FORECAST_DIGITS),
    "forecast_components": additive(
        "website_category_analysis", "Total_Profit", 30, "majorcategory", FORECAST_DIGITS
    ),
}


# -- reports over a range of weeks ---------------------------------------------------------

for _table in (*WEEKLY, "pricing_weeks"):
    VIEWS[f"{_table}_recent"] = since(_table, 90)
    VIEWS[f"{_table}_none"] = f"""SELECT * FROM {_table} WHERE "Week" < DATE '1901-01-01'"""


def cut(name: str, suffix: str) -> str:
    """A statement over the tables of a range; cards over no rows show 0, averages NULL."""
    body = re.sub(
        r"\b(FROM|JOIN) (\w+)",
        lambda m: f"{m[0]}{suffix}" if f"{m[2]}{suffix}" in VIEWS else m[0],
        STATEMENTS[name],
    )
    if name == "kpi_affiliate":
        averages = "avg_commission, avg_sales, avg_net"
        return f"SELECT coalesce(COLUMNS(* EXCLUDE ({averages})), 0), {averages} FROM ({body})"
    return f"SELECT coalesce(COLUMNS(*), 0) FROM ({body})" if name.startswith("kpi_") else body


CARDS = (
    "kpi_website kpi_website_weighted kpi_facebook kpi_ga kpi_google_ads kpi_bing kpi_affiliate "
    "profit_by_platform"
).split()
REPORTS = CARDS + (
    "affiliate_share top10_campaigns_by_revenue overall_top_campaigns websource_top10_trend "
    "pricing_top10_trend promo_global_top10 promo_uplift_top10 "
    "best_strategy_combo authors_top10 author_list author_report author_trend bing_top10_period "
    "affiliate_daily affiliate_top10_period weekly_trend weekly_trend_google_ads weekly_trend_bing"
).split()
STATEMENTS |= {f"{name}_last_90_days": cut(name, "_recent") for name in REPORTS}
STATEMENTS |= {f"{name}_no_weeks": cut(name, "_none") for name in CARDS}


def statement(name: str) -> str:
    """The SQL of a query, with the views it uses as common table expressions."""
    return _with_views(STATEMENTS[name])


def _with_views(body: str) -> str:
    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+\(?(\w+)", text)):
            if word in VIEWS and word not in needed and word != own:
                visit(VIEWS[word], word)
                needed.append(word)

    visit(body)
    if not needed:
        return body
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = body.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{views},\n{body.removeprefix(start)}"
    return f"WITH {views}\n{body}"
