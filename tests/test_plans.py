"""Shapes of plans, the batch run, and relations between tables."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from weekloom.operators import ads
from weekloom.plans.batch import HUGE, METHOD_LIMIT, run_batch
from weekloom.plans.tables import OUTPUTS, TABLES, Tables, Top
from weekloom.sources.retail import WEBSITE_SALES, retail_source
from weekloom.sources.schemas import SCHEMAS, schema_of
from weekloom.sources.tables import (
    catalog_source, fresh_folder, parquet_source, save_table, shared_folder, spread, write_table,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(retail_source(spark, SF))


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", [n for n, t in TABLES.items() if isinstance(t, Top)])
def test_rankings_limit_before_the_shuffle(tables, name):
    text = plan(tables[name])
    assert len(re.findall(r"^.*WindowGroupLimit", text, re.M)) >= 2


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"batch_outputs"}))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert "ArrowEvalPython" not in text
    assert ("FlatMapGroupsInPandas" in text) == (
        name in ("forecast_additive", "forecast_components"))


def test_scans_read_only_what_a_table_needs(tables):
    text = plan(tables["website_weekly_overall"])
    assert "customer.parquet" not in text
    assert "nation.parquet" not in text
    assert "p_brand" not in text
    assert "customer.parquet" in plan(tables["website_geo_source_analysis"])


@pytest.mark.parametrize("name", ["website_websource_analysis", "website_geo_source_analysis"])
def test_rules_run_on_groups(tables, name):
    """The chain of labels is a result of the first grouping, whose keys it is not part of."""
    text = tables[name]._jdf.queryExecution().optimizedPlan().toString()
    (line,) = [line for line in text.splitlines() if "betterworldbooks.zendesk.com" in line]
    keys, results = re.search(r"Aggregate \[(.*?)\], \[(.*)", line).groups()
    assert "_source#" in keys and "Contains" not in keys
    assert "Contains" in results


@pytest.mark.parametrize("fanout", [False, True])
def test_a_busy_ad_day_is_shared_by_tasks(spark, fanout):
    """One ad-day with half the insights, and all rows without ids: no task joins much of them."""
    insights = spark.sql(
        """SELECT CASE WHEN id % 2 = 0 THEN '2024-01-01' ELSE concat('d', id) END AS date,
        CASE WHEN id % 2 = 1 THEN CAST(id AS STRING) END AS campaign_id, CAST(NULL AS STRING) AS adset_id, 'x' AS ad_id,
        'c' AS campaign_name, CAST(id AS DECIMAL(18,4)) AS spend, id AS impressions, id AS clicks FROM range(4000)""")
    actions = spark.sql(
        """SELECT CASE WHEN id < 5 THEN '2024-01-01' ELSE concat('d', id) END AS date,
        CASE WHEN id >= 5 THEN CAST(id AS STRING) END AS campaign_id, CAST(NULL AS STRING) AS adset_id, 'x' AS ad_id,
        'purchase' AS action_type, CAST(id AS DECIMAL(18,4)) AS value FROM range(50)""")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = ads.join_ad_actions(insights, actions, fanout=fanout)
        assert "concat(date" not in plan(out)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        found = out.groupBy("date").agg(F.count("*").alias("n"), F.sum("value").alias("v")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(tasks) < 0.1 * sum(tasks)
    assert sum(tasks) == (12_000 if fanout else 4_000)
    (busy,) = [r for r in found if r["date"] == "2024-01-01"]
    assert (busy["n"], int(busy["v"])) == ((10_000, 20_000) if fanout else (2_000, 20_000))


def test_website_columns_match_the_schema():
    assert list(WEBSITE_SALES) == schema_of("website_sales").names


def test_spread_leaves_many_splits_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, cores + 1)
    assert spread(many, "id") is many
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() == cores


def test_thirty_outputs():
    assert len(OUTPUTS) == 30


def test_batch_writes_what_the_tables_hold(spark, tables):
    names = ["website_weekly_campaign", "website_weekly_top_campaign",
             "website_campaign_analysis", "website_promotion_analysis",
             "facebook_ads_top10_campaigns", "affiliate_sales_weekly_overall"]
    layer = run_batch(spark, retail_source(spark, SF), fresh_folder(spark, "test"), names)
    assert sorted(layer.current()) == sorted(names)
    for name in names:
        assert layer[name].exceptAll(tables[name]).count() == 0
        assert tables[name].exceptAll(layer[name]).count() == 0


def test_batch_leaves_no_method_uncompiled(spark):
    """The staged orders as one method would only be interpreted; the session keeps its own setting."""
    before, seen, source = spark.conf.get(METHOD_LIMIT), [], retail_source(spark, SF)

    def watched(name, columns=None):
        seen.append(int(spark.conf.get(METHOD_LIMIT)))
        return source(name, columns)

    def failing(name, columns=None):
        raise KeyError(name)

    run_batch(spark, watched, fresh_folder(spark, "test"), ["website_weekly_overall"])
    assert seen and max(seen) <= HUGE
    with pytest.raises(KeyError):
        run_batch(spark, failing, fresh_folder(spark, "test"), ["website_weekly_overall"])
    assert spark.conf.get(METHOD_LIMIT) == before


def test_batch_scans_a_source_once_for_tables_of_common_groups(spark, tables):
    names = ["website_weekly_campaign", "website_weekly_overall", "website_customer_analysis",
             "website_websource_analysis", "google_ads_weekly_overall", "google_ads_weekly_campaign",
             "bing_ads_weekly_overall", "bing_ads_weekly_campaign"]
    seen, source = [], retail_source(spark, SF)

    def watched(name, columns=None):
        seen.append(name)
        return source(name, columns)

    layer = run_batch(spark, watched, fresh_folder(spark, "test"), names)
    assert sorted(seen) == ["bing_ads_stats", "google_ads_stats", "website_sales"]
    for name in names:
        assert layer[name].exceptAll(tables[name]).count() == 0
        assert tables[name].exceptAll(layer[name]).count() == 0


def test_tables_from_stored_sources(spark, tables):
    """The same tables come out of sources kept as parquet."""
    base = fresh_folder(spark, "sources")
    source = retail_source(spark, SF)
    for name in SCHEMAS:
        write_table(source(name, None), base, name)
    stored = Tables(parquet_source(spark, base))
    for name in ("website_geo_source_analysis", "ga_weekly_top_sources", "fb_weekly_campaigns"):
        assert stored[name].exceptAll(tables[name]).count() == 0
    with pytest.raises(ValueError, match="no_such"):
        parquet_source(spark, base)("bing_ads_stats", ["no_such"])


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS loom LOCATION '{tmp_path}'")
    try:
        save_table(spark.range(3), "numbers", "loom")
        assert catalog_source(spark, "loom")("numbers", ["id"]).count() == 3
    finally:
        spark.sql("DROP DATABASE loom CASCADE")


def test_shared_folder_is_stable(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_campaigns_add_up_to_the_week(tables):
    columns = ["Total_Revenue", "Order_Count", "Total_Books"]
    parts = tables["website_weekly_campaign"].groupBy("Week").agg(
        *(F.sum(c).alias(c) for c in columns))
    whole = tables["website_weekly_overall"]
    both = parts.alias("p").join(whole.alias("w"), "Week", "full")
    gap = F.greatest(*(F.abs(F.col(f"p.{c}") - F.col(f"w.{c}")) for c in columns))
    assert both.where(gap.isNull() | (gap > 1e-4)).count() == 0


@pytest.mark.parametrize("name", [n for n, t in TABLES.items() if isinstance(t, Top)])
def test_rankings_are_at_most_ten_rows_of_their_table(tables, name):
    top = tables[name].cache()
    assert top.groupBy("Week").count().where("count > 10").count() == 0
    assert top.exceptAll(tables[TABLES[name].of]).count() == 0


def test_dataset_names(tables):
    assert tables["Bing Ads"].columns == tables["bing_ads_weekly_overall"].columns
    alias = tables["website_promotion_daily_uplift_top10_tidy"]
    assert alias.columns == tables["website_promotion_daily_uplift_top10"].columns
