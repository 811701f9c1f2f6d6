"""Operators on small frames that show one rule each."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from weekloom.functions import measures as m
from weekloom.operators import ads, distinct, explore, report, uplift
from weekloom.operators import weeks as wk
from weekloom.operators.rank import keep_top_k, top_n_per_group
from weekloom.operators.rollup import add_up, group_parts, rollup, rollup_late, rollup_parts
from weekloom.plans import prepare
from weekloom.plans.tables import Range, Tables
from weekloom.sources.schemas import SCHEMAS, check_columns, schema_of
from weekloom.sources.tables import parquet_source

W1, W2, W3 = dt.date(2021, 5, 17), dt.date(2021, 5, 24), dt.date(2021, 5, 31)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# -- rollups -----------------------------------------------------------------------------


def test_rollup_null_rules(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "x", None), ("b", "x", None), (None, "x", 5.0), ("a", None, 7.0)],
        "k string, g string, v double",
    )
    pack = {"s": m.total("v"), "n": m.count("v"), "d": m.distinct("v"), "avg": m.mean("v")}
    assert rows(rollup(df, ["k", "g"], pack)) == [
        ("a", "x", 1.0, 1, 1, 1.0), ("b", "x", 0.0, 0, 0, None)]
    kept = rollup(df, ["k", "g"], {"s": m.total("v")}, nullable=["k"])
    assert (None, "x", 5.0) in rows(kept)
    assert rows(rollup(df.where("false"), [], {"s": m.total("v")})) == [(0.0,)]


def test_rollup_keeps_whole_numbers_whole(spark):
    df = spark.createDataFrame([(True, 1, 1.5), (False, 2, 1.0)], "b boolean, i int, d double")
    out = rollup(df, [], {c: m.total(c) for c in "bid"})
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "double"]
    assert rows(out) == [(1, 3, 2.5)]


def test_ratios_of_zero_and_negative_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (1.0, 4.0)], "a double, b double")
    out = m.with_derived(df, {"r": m.percent("a", "b"), "d": m.minus("a", "b")})
    assert rows(out, "b") == [(1.0, -1.0, 0.0, 2.0), (1.0, 0.0, 0.0, 1.0), (1.0, 4.0, 25.0, -3.0)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, i int")
    measures = {"s": m.total("v"), "a": m.mean("v")}
    assert rows(rollup(df, [], measures, exact=True)) == [(2.0, 2.0)]


def test_sums_of_doubles_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    """Two parquet copies of a source with DOUBLE money, one the other way round."""
    amounts = [1e30, 0.1, 0.2, -1e30, 0.7, 1e-20] * 20
    found = []
    for label, order in (("up", amounts), ("down", amounts[::-1])):
        data = [("2024-01-03", i, v) for i, v in enumerate(order)]
        schema = "eventdate string, marketordernumber long, saleamountusd double"
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{label}/affiliate_sales")
        sales = prepare.affiliate_sales(parquet_source(spark, f"{tmp_path}/{label}"), ["saleamountusd"])
        found.append(rows(rollup(sales, ["Week"], {"s": m.total("saleamountusd")}, exact=True)))
    assert found[0] == found[1] == [(dt.date(2024, 1, 1), math.fsum(amounts))]


def test_range_cuts_every_table_with_a_week(spark):
    """Labels are read as weeks; bounds are included."""
    written = {
        "website_weekly_overall": spark.sql("SELECT DATE '2024-01-01' AS Week, 1 AS n UNION ALL SELECT DATE '2024-01-08', 2"),
        "website_pricing_strategy_analysis": spark.sql(
            "SELECT '2024-01-01/2024-01-07' AS Week, 1 AS n UNION ALL SELECT '2024-01-08/2024-01-14', 2"),
    }
    cut = Range(Tables(None, written=written), lambda d: wk.filter_weeks(d, "2024-01-08", "2024-01-31"))
    for name in written:
        assert [r["n"] for r in cut[name].collect()] == [2]


def test_rollup_does_not_depend_on_partitions(spark):
    df = spark.range(10_000).selectExpr(
        "id % 7 AS k", "CAST(id * 0.37 AS DECIMAL(18,4)) AS v", "id % 100 AS o")
    pack = {"s": m.total("v"), "d": m.distinct("o"), "avg": m.mean("v")}
    assert rows(rollup(df.repartition(1), ["k"], pack)) == rows(
        rollup(df.repartition(13), ["k"], pack))


def test_keys_made_after_the_first_grouping(spark):
    """The same groups as with keys made first, NULL keys, sums over NULLs and flags included."""
    data = [(i % 3, [None, "a.x", "b.x", "b.y", "!"][i % 5], i if i % 4 else None, i % 2 == 0) for i in range(60)]
    df = spark.createDataFrame(data, "k int, raw string, v int, f boolean")
    df = df.withColumn("d", F.expr("CAST(v AS DECIMAL(18,4)) / 7"))
    made = lambda c: F.when(F.col(c) != "!", F.split_part(c, F.lit("."), F.lit(1)))
    pack = {"v": m.total("v"), "d": m.total("d"), "f": m.total("f"), "n": m.count("v")}
    for nullable in ([], ["label"]):
        late = rollup_late(df, ["k", "label"], {"label": ("raw", made)}, pack, {"r": m.Ratio("d", "n")}, nullable)
        first = rollup(df.withColumn("label", made("raw")), ["k", "label"], pack, {"r": m.Ratio("d", "n")}, nullable)
        assert late.dtypes == first.dtypes
        assert sorted(late.collect(), key=str) == sorted(first.collect(), key=str)
    with pytest.raises(ValueError, match="add up"):
        rollup_late(df, ["k"], {}, {"x": m.distinct("v")})


def test_rollups_of_groups_are_rollups_of_rows(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, True), ("a", "x", 1, True), ("a", "y", None, False), ("a", None, 5, None),
         (None, "x", 7, True), ("b", None, None, None), ("b", None, None, None)],
        "k string, g string, v int, f boolean",
    ).withColumn("d", F.expr("CAST(v / 4 AS DECIMAL(18,4))"))
    pack = {"s": m.total("v"), "n": m.count("v"), "f": m.total("f"), "d": m.total("d"), "again": m.total("d")}
    ratios = {"r": m.Ratio("d", "n")}
    assert add_up(df, pack.values())
    groups = group_parts(df, ["k", "g"], pack.values())
    for keys, nullable in ((["k", "g"], []), (["k"], []), (["g"], []), (["k", "g"], ["g"])):
        whole = rollup(df, keys, pack, ratios, nullable)
        again = rollup_parts(groups, keys, pack, ratios, nullable)
        assert again.dtypes == whole.dtypes
        assert sorted(rows(again), key=str) == sorted(rows(whole), key=str)
    real = df.withColumn("v", F.col("v").cast("double"))
    assert not add_up(real, [m.total("v")]) and not add_up(df, [m.distinct("v")])


def test_distinct_numbers_of_any_weeks(spark):
    """Bitmaps of single weeks give the count over any of them; numbers of every size and sign."""
    pick = random.Random(2)
    numbers = [0, 1, -1, -32768, 32767, 32768, 32769, 10**12, -(10**12), *range(40)]
    data = [(dt.date(2024, 1, 1) + dt.timedelta(7 * pick.randint(0, 4)), pick.choice([*numbers, None])) for _ in range(400)]
    data.append((None, 77))
    stored = distinct.weekly_bitmaps(spark.createDataFrame(data, "Week date, o long"), "o")
    for first in range(5):
        for last in range(first - 1, 5):
            weeks = {dt.date(2024, 1, 1) + dt.timedelta(7 * w) for w in range(first, last + 1)}
            cut = stored.where(F.col("Week").isin(*weeks)) if weeks else stored.where("false")
            expected = len({o for w, o in data if w in weeks and o is not None})
            assert [tuple(r) for r in distinct.distinct_count(cut, "orders").collect()] == [(expected,)]


# -- rankings ----------------------------------------------------------------------------


def test_top_n_breaks_ties_by_key(spark):
    data = [(W1, f"c{i:02}", 5.0 if i > 3 else 9.0) for i in range(12)] + [(None, "z", 1.0)]
    df = spark.createDataFrame(data, "Week date, c string, v double")
    out = rows(top_n_per_group(df.repartition(5), "Week", "v", 10, ["c"]))
    assert [c for _, c, _ in out] == [f"c{i:02}" for i in range(10)]


def test_top_n_puts_nulls_last_or_drops_them(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", -5.0)], "g int, c string, v double")
    assert len(rows(top_n_per_group(df, "g", "v", 2, ["c"]))) == 2
    assert rows(top_n_per_group(df, "g", "v", 1, ["c"])) == [(1, "b", -5.0)]
    assert rows(top_n_per_group(df, "g", "v", 2, ["c"], True)) == [(1, "b", -5.0)]


def test_keep_top_k_keeps_all_rows_of_the_best(spark):
    data = [("a", 1.0), ("a", 1.0), ("b", 5.0), ("c", 0.5)]
    df = spark.createDataFrame(data, "k string, v double")
    assert rows(keep_top_k(df, "k", m.total("v"), 2)) == [("a", 1.0), ("a", 1.0), ("b", 5.0)]


# -- weeks -------------------------------------------------------------------------------


def weekly(spark, *values):
    data = [(W1 + dt.timedelta(7 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "Week date, v double")


def test_range_includes_both_ends(spark):
    df = weekly(spark, 1.0, 2.0, 3.0, 4.0)
    assert [v for _, v in rows(wk.filter_weeks(df, W2, W3))] == [2.0, 3.0]
    assert [v for _, v in rows(wk.preset_range(df, df, "Last 7 Days"))] == [3.0, 4.0]
    assert len(rows(wk.preset_range(df, df, "Lifetime"))) == 4
    other = df.withColumnRenamed("Week", "w")
    assert wk.filter_weeks(other, W2, W3) is other


def test_change_from_week_to_week(spark):
    df = weekly(spark, 4.0, 0.0, 6.0)
    out = rows(wk.week_over_week(df, "v", "p", "c"), "Week")
    assert [(p, c) for _, _, p, c in out] == [(None, None), (4.0, -4.0), (0.0, 6.0)]
    latest = rows(wk.latest_change(df, "v", "p", "c"))
    assert latest == [(W3, 6.0, 0.0, 6.0, 6.0, 0.0)]
    quiet = rows(wk.latest_change(df, "v", "p", "c", zero_when_unknown=True))
    assert quiet == [(W3, 6.0, 0.0, 6.0, 0.0, 0.0)]
    single = weekly(spark, 4.0)
    assert rows(wk.latest_change(single, "v", "p", "c"))[0][2:] == (None, None, None, None)
    assert rows(wk.latest_change(single, "v", "p", "c", zero_when_unknown=True))[0][4:] == (0, 0)


# -- uplift ------------------------------------------------------------------------------


def test_uplift_per_active_day(spark):
    day = lambda n: W1 + dt.timedelta(n)
    data = [
        (W1, "NoPromotion", day(0), 10.0, 2.0, 1), (W1, "NoPromotion", day(1), 10.0, 2.0, 2),
        (W1, "A", day(0), 30.0, 1.0, 3), (W1, "A", day(0), 10.0, 1.0, None),
        (W2, "A", day(7), 30.0, 1.0, 5),
        (W3, "NoPromotion", day(14), 0.0, -1.0, None), (W3, "B", day(14), 1.0, 1.0, 7),
    ]
    sales = spark.createDataFrame(
        data, "Week date, promo_clean string, order_ts date, novusd double, "
        "contributionmargin double, marketordernumber bigint")
    assert rows(uplift.promo_uplift(sales)) == [
        (W1, "A", 300.0, 0.0, 0.0), (W2, "A", None, None, None), (W3, "B", None, None, None)]
    assert len(rows(uplift.promo_uplift(sales, n=0))) == 0


def test_pivot_uplift(spark):
    df = spark.createDataFrame(
        [(W1, 2.0, 3.0, None), (W2, 0.0, 3.0, 1.0)],
        "Week date, NoPromotion double, a double, b double")
    out = uplift.pivot_uplift(df)
    assert out.columns[-2:] == ["a_uplift", "b_uplift"]
    assert [r[-2:] for r in rows(out, "Week")] == [(0.5, None), (None, None)]
    with pytest.raises(ValueError, match="baseline"):
        uplift.pivot_uplift(df.drop("NoPromotion"))


# -- ads ---------------------------------------------------------------------------------

INSIGHTS = "date string, campaign_id string, adset_id string, ad_id string, " \
    "campaign_name string, spend double, impressions bigint, clicks bigint"
ACTIONS = "date string, campaign_id string, adset_id string, ad_id string, " \
    "action_type string, value double"


def ad_frames(spark):
    insights = [
        ("2021-05-18", "1", None, "9", "n", 2.0, 10, 1),
        ("2021-05-18", "1", None, "9", "n", 4.0, 20, 2),
        ("2021-05-18", "2", "5", "8", None, 0.0, 5, 0),
        ("2021-05-19", "3", "5", "7", "m", 3.0, 5, 0),
        ("bad", "3", "5", "7", "m", 3.0, 5, 0),
    ]
    actions = [
        ("2021-05-18", "1", None, "9", "purchase", 8.0),
        ("2021-05-18", "1", None, "9", "omni_purchase", 4.0),
        ("2021-05-18", "1", None, "9", "web_in_store_purchase", None),
        ("2021-05-18", "1", None, "9", "link_click", 100.0),
        ("2021-05-18", "2", "5", "8", "purchase", 1.0),
    ]
    return spark.createDataFrame(insights, INSIGHTS), spark.createDataFrame(actions, ACTIONS)


def test_join_fans_out_and_matches_missing_ids(spark):
    insights, actions = ad_frames(spark)
    out = ads.join_ad_actions(insights, actions)
    first = out.where("campaign_id = '1'")
    assert first.count() == 6
    assert rows(first.agg(F.sum("spend"), F.sum("value"))) == [(18.0, 24.0)]
    assert rows(out.where("campaign_id = '2'").select("value", "ROI")) == [(1.0, 0.0)]
    assert rows(out.where("ad_id = '7'").select("value", "ROI")) == [(None, 0.0), (None, 0.0)]
    assert ads.join_ad_actions(insights, actions, fanout=False).count() == 5


def test_totals_equal_the_fanned_out_join(spark):
    insights, actions = ad_frames(spark)
    keys = [*ads.AD_DAY, "campaign_name"]
    plain = ads.join_ad_actions(insights, actions).groupBy(*keys).agg(
        F.sum("value"), F.sum("spend"), F.sum("impressions"), F.sum("clicks"), F.sum("ROI"),
        F.count("*"))
    totals = ads.ad_day_totals(insights, actions)
    order = ["date", "campaign_id"]
    assert rows(totals, *order) == rows(plain, *order)


def test_lenient_weeks_and_micros(spark):
    frames = {
        "bing_ads_stats": spark.createDataFrame(
            [("2021-05-18", "a", 1.0, 2.0, 1, 1, 1.0), ("n/a", "a", 1.0, 2.0, 1, 1, 1.0)],
            schema_of("bing_ads_stats")),
        "google_ads_stats": spark.createDataFrame(
            [("2021-05-24", "a", 1_500_000, 2.0, 1, 1, 1.0)], schema_of("google_ads_stats")),
    }
    source = lambda name, columns=None: frames[name]
    bing = prepare.bing_ads(source, ["Week", "cost"])
    assert rows(bing) == [(None, 2.0), (W1, 2.0)]
    google = prepare.google_ads(source, ["Week", "cost"])
    assert [(w, float(c)) for w, c in rows(google)] == [(dt.date(2021, 5, 18), 1.5)]
    monday = prepare.google_ads(source, ["Week"], anchor="MON")
    assert rows(monday) == [(W2,)]
    ready = frames["google_ads_stats"].withColumn("cost", F.lit(7.0))
    assert prepare.with_cost(ready) is ready


def test_affiliate_weeks_may_keep_the_time(spark):
    schema = schema_of("affiliate_sales")
    data = [("2021-05-18 10:00:00", 1, "p", 1.0, 0.0, 0.0, 0.0, 0.0)]
    source = lambda name, columns=None: spark.createDataFrame(data, schema)
    assert rows(prepare.affiliate_sales(source, []).select("Week")) == [(W1,)]
    kept = prepare.affiliate_sales(source, [], keep_time=True)
    assert rows(kept.select("Week")) == [(dt.datetime(2021, 5, 17, 10),)]


def test_missing_source_columns_are_named(spark):
    with pytest.raises(ValueError, match="novusd"):
        check_columns("website_sales", spark.range(1), ["id", "novusd"])
    assert all(schema_of(t).fields for t in SCHEMAS)


# -- reports -----------------------------------------------------------------------------


def test_cards_of_empty_tables_are_zero(spark):
    website = spark.createDataFrame(
        [], "Total_Revenue double, Total_Profit double, Profit_Margin double, AOV double")
    assert rows(report.kpi_website(website)) == [(0.0, 0.0, 0.0, 0.0)]
    ad = spark.createDataFrame([], "conversions_value double, revenue double, cost double")
    assert rows(report.profit_by_platform(ad, ad, ad)) == [
        ("Bing Ads", 0.0), ("Facebook Ads", 0.0), ("Google Ads", 0.0)]


def test_share_of_total_counts_all_rows(spark):
    data = [(W1, f"p{i}", float(i)) for i in range(1, 5)]
    df = spark.createDataFrame(data, "Week date, publishername string, Total_Sales double")
    out = rows(report.affiliate_share(df, 2), "publishername")
    assert [r[3] for r in out] == [30.0, 40.0]


# -- exploration -------------------------------------------------------------------------


def test_pivot_on_given_columns_runs_nothing_while_built(spark):
    def watched(column):
        return F.when(F.col(column).isNull(), F.raise_error(F.lit("run"))).otherwise(F.col(column))

    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0), ("c", None, 3.0)], "r string, c string, v double")
    strict = df.withColumn("c", watched("c"))
    assert explore.pivot(strict, "r", "c", "v", values=["y", "z"]).columns == ["r", "y", "z"]
    assert rows(explore.pivot(df, "r", "c", "v", values=["y", "z"])) == [("a", None, None), ("b", 2.0, None)]


def test_pivot_and_contains_take_any_column_name(spark):
    df = spark.createDataFrame([("a", "x.y", 1.0), ("b", "z", 2.0)], "`r.r` string, `c.c` string, `v.v` double")
    for how in ("sum", "mean", "max"):
        out = explore.pivot(df, "r.r", "c.c", "v.v", how)
        assert out.columns == ["r.r", "x.y", "z"]
        assert sorted(map(tuple, out.collect())) == [("a", 1.0, None), ("b", None, 2.0)]
    assert [tuple(r) for r in explore.contains(df, "c.c", "X").collect()] == [("a", "x.y", 1.0)]


def test_pivot_of_dates_and_of_too_many_values(spark):
    df = spark.sql("SELECT id % 2 AS r, date_add(DATE '2024-01-01', CAST(id AS INT)) AS d, id AS v FROM range(5)")
    assert explore.pivot(df, "r", "d", "v").columns == ["r", *(f"2024-01-0{i}" for i in range(1, 6))]
    spark.conf.set("spark.sql.pivotMaxValues", "4")
    try:
        with pytest.raises(ValueError, match="more than 4"):
            explore.pivot(df, "r", "d", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_pivot_of_missing_cells(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", None), ("b", "y", None), (None, "x", 5.0), ("b", None, 9.0),
         ("a", "x", 3.0)], "r string, c string, v double")
    assert explore.pivot(df, "r", "c", "v").columns == ["r", "x", "y"]
    assert rows(explore.pivot(df, "r", "c", "v")) == [("a", 4.0, 0.0), ("b", None, 0.0)]
    assert rows(explore.pivot(df, "r", "c", "v", "mean")) == [("a", 2.0)]
    assert rows(explore.pivot(df, "r", "c", "v", "max")) == [("a", 3.0)]
    assert rows(explore.pivot(df, "r", "r", "v", "min")) == [("a", 1.0, None), ("b", None, 9.0)]
    with pytest.raises(ValueError, match="median"):
        explore.pivot(df, "r", "c", "v", "median")


def test_contains_with_an_empty_pattern_keeps_all(spark):
    df = spark.createDataFrame([("Ab",), (None,)], "c string")
    assert explore.contains(df, "c", "").count() == 2
    assert rows(explore.contains(df, "c", "^aB$")) == [("Ab",)]


def test_columns_by_type(spark):
    df = spark.sql("SELECT 1 AS i, 1.5BD AS d, 'a' AS s, DATE'2021-01-01' AS t, true AS b")
    assert explore.numeric_columns(df) == ["i", "d"]
    assert explore.text_columns(df) == ["s"]
    assert explore.time_columns(df) == ["t"]


def test_scatter_matrix(spark):
    df = spark.createDataFrame([(1, 2.0, W1)], "a int, b double, Week date")
    assert rows(explore.scatter_matrix(df, ["a", "b"])) == [
        (W1, "a", "a", 1.0, 1.0), (W1, "a", "b", 1.0, 2.0),
        (W1, "b", "a", 2.0, 1.0), (W1, "b", "b", 2.0, 2.0)]
    with pytest.raises(ValueError, match="two"):
        explore.scatter_matrix(df, ["a"])
