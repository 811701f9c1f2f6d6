"""The stored weekly layer: versions, pruning, and what readers see while a table is written."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as registry
from test_plans import plan
from weekloom.plans.batch import run_batch
from weekloom.plans.tables import Tables
from weekloom.sources.layer import YEAR, Layer, StoredTables, layer_source, stamp_of
from weekloom.sources.retail import retail_source

SF = "/root/testdata/sf0.001"
STORED = {
    name: query.cut for name, query in registry.queries().items() if getattr(query, "cut", None)
}


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, str(tmp_path / "layer"))


@pytest.fixture
def weeks(spark):
    return spark.sql(
        """SELECT date_add(DATE '2021-01-04', CAST(7 * id AS INT)) AS Week, id AS n FROM range(200)
        UNION ALL SELECT NULL, -1"""
    )


def test_what_is_written_is_read(layer, weeks):
    found = layer.replace("numbers", weeks)
    assert found.columns == ["Week", "n"]
    assert sorted(found.collect(), key=str) == sorted(weeks.collect(), key=str)
    version = layer.current()["numbers"]
    assert (version.row_count, version.first_week, version.last_week) == (
        201, dt.date(2021, 1, 4), dt.date(2024, 10, 28))


def test_ranges_read_the_folders_of_their_years_only(layer, weeks):
    layer.replace("numbers", weeks)
    cut = layer.between("numbers", dt.date(2022, 12, 26), dt.date(2023, 1, 9))
    assert sorted(r["n"] for r in cut.collect()) == [103, 104, 105]
    assert "PartitionFilters: [isnotnull(Week_Year" in plan(cut)
    assert "GreaterThanOrEqual(Week," in plan(cut)
    folders = {re.search(r"Week_Year=(\d+)", f)[1] for f in cut.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert folders == {"2022", "2023"}
    assert layer.between("numbers", None, None).count() == 0
    recent = layer.last_days("numbers", 14, "numbers")
    assert sorted(r["n"] for r in recent.collect()) == [197, 198, 199]
    assert layer.last_days("numbers", None, "numbers").count() == 200


def test_labels_and_moments_and_tables_without_weeks(spark, layer):
    layer.replace("labels", spark.sql("SELECT '2021-01-04/2021-01-10' AS Week, 1 AS n UNION ALL SELECT 'NaT', 2"))
    layer.replace("moments", spark.sql("SELECT TIMESTAMP_NTZ '2021-01-04 10:00:00' AS Week, 1 AS n"))
    layer.replace("plain", spark.range(3))
    day = dt.date(2021, 1, 4), dt.date(2021, 1, 5)
    (row,) = layer.between("labels", *day).collect()
    assert tuple(row) == (dt.datetime(2021, 1, 4), 1)
    assert {r["Week"] for r in layer["labels"].collect()} == {"2021-01-04/2021-01-10", "NaT"}
    assert layer.between("moments", *day).count() == 1
    assert layer.between("plain", *day).count() == 3


def test_empty_tables(layer, weeks):
    layer.replace("none", weeks.where("false"))
    assert layer["none"].count() == 0
    assert layer.last_days("none", 90, "none").count() == 0
    with pytest.raises(KeyError, match="other"):
        layer["other"]


def test_a_failed_write_leaves_the_old_rows(layer, weeks):
    layer.replace("numbers", weeks.where("n < 3"))
    broken = weeks.select("Week", F.when(F.col("n") == 150, F.raise_error(F.lit("stop"))).otherwise(F.col("n")).cast("long").alias("n"))
    with pytest.raises(PySparkException, match="stop"):
        layer.replace("numbers", broken)
    for reader in (layer, Layer(layer.spark, layer.base)):
        reader.refresh()
        assert sorted(r["n"] for r in reader["numbers"].collect()) == [-1, 0, 1, 2]


def test_readers_keep_their_version_until_the_new_one_is_published(layer, weeks):
    before = layer.replace("numbers", weeks.where("n < 3 AND n >= 0"))
    reader = Layer(layer.spark, layer.base)
    assert reader["numbers"].count() == 3
    unpublished = layer.write("numbers", weeks)
    assert Layer(layer.spark, layer.base)["numbers"].count() == 3
    layer.publish([unpublished])
    assert layer["numbers"].count() == 201
    assert before.count() == 3  # a query planned earlier still finds its files
    old = layer.outdated()
    assert len(old) == 1 and old[0] not in unpublished.path
    assert layer.outdated(keep=2) == []


def test_a_batch_is_published_at_once_or_not_at_all(spark, tmp_path):
    source = retail_source(spark, SF)
    names = ["website_weekly_campaign", "website_weekly_top_campaign"]
    target = str(tmp_path / "batch")
    layer = run_batch(spark, source, target, names)
    first = {n: layer.current()[n].path for n in names}

    def broken(table, columns=None):
        return source(table, columns).where(F.raise_error(F.lit("gone")).isNull())

    with pytest.raises(PySparkException, match="gone"):
        run_batch(spark, broken, target, names)
    again = Layer(spark, target)
    assert {n: again.current()[n].path for n in names} == first
    stored = layer_source(again)
    assert stored(names[1], None).exceptAll(Tables(source)[names[1]]).count() == 0
    assert stored(names[0], ["Week"]).columns == ["Week"]


def test_stored_tables_follow_the_files_they_are_made_from(spark, tmp_path):
    files = str(tmp_path / "files")
    made = []

    def make(name):
        made.append(name)
        return spark.read.parquet(files).select(F.lit("2024-01-01").cast("date").alias("Week"), "id")

    layer = Layer(spark, str(tmp_path / "layer"))
    spark.range(3).write.parquet(files)

    def count():
        return StoredTables(layer, make, stamp_of(spark, [files]), {"alias": "t"})["alias"].count()

    assert (count(), count(), made) == (3, 3, ["t"])
    spark.range(5).write.mode("append").parquet(files)
    assert (count(), made) == (8, ["t", "t"])
    fresh = StoredTables(Layer(spark, str(tmp_path / "other")), make, "now")
    assert fresh.last_days(7, "t")["t"].count() == 8


@pytest.mark.parametrize("name", sorted(STORED))
def test_queries_over_stored_tables_scan_no_facts(spark, name):
    """Tables read twice, for shares and trends, are stored; those over a range read its partitions."""
    text = plan(registry.queries()[name](spark, SF))
    for raw in ("lineitem", "events", "orders", "part", "customer"):
        assert f"{raw}.parquet" not in text
    scans = len(re.findall(r"^\(\d+\) Scan parquet", text, re.M))
    assert scans >= 1
    if STORED[name] is not registry._whole:
        assert len(re.findall(rf"PartitionFilters: \[isnotnull\({YEAR}", text)) == scans


def test_shares_and_trends_are_stored():
    for name in ("affiliate_share", "websource_top10_trend", "pricing_top10_trend", "promo_pivot_uplift"):
        assert STORED[name] is registry._whole
