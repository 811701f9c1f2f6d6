"""Column functions on hand-made values."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.functions import measures as m


def values(spark, cases, column):
    """The function's value for each case, in the order of the cases."""
    rows = [(i, *(case if isinstance(case, tuple) else (case,))) for i, case in enumerate(cases)]
    names = ", ".join(["i int", *(f"c{k} string" for k in range(1, len(rows[0])))])
    df = spark.createDataFrame(rows, names)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


SOURCES = {
    None: "unspecified",
    "": "unspecified",
    " \t　 ": "unspecified",
    "?utm=1": "",
    "/": "",
    "https://L.FACEBOOK.com/x": "Facebook",
    "bing.google.example": "Google",
    "affiliate-klaviyo": "Affiliate",
    "snapsale": "snapsale",
    "jumpnps": "NPS",
    "Blog.Example.org/?p=2": "blog.example.org",
    "a // ": "a ",
    "x.org/?to=google": "x.org",
    "(direct)": "BetterWorldBooks",
    "later-linkinbio": "Linkin.bio",
}


def test_unify_source(spark):
    assert values(spark, list(SOURCES), text.unify_source("c1")) == list(SOURCES.values())


def test_unify_source_with_other_rules(spark):
    rules = [("Shop", ("shop", "store")), ("Mail", ("mail",))]
    found = values(spark, ["my-store/", "Mail-Shop", "web"], text.unify_source("c1", rules))
    assert found == ["Shop", "Shop", "web"]


CAMPAIGNS = {
    None: "unspecified",
    "!!!": "unspecified",
    "": "unspecified",
    "GCLID": "google campaign",
    "www.google.com": "google campaign",
    " Spring  Sale! ": "spring sale",
    "gclid_x": "gclid_x",
    "été-2024": "été2024",
    "a - b": "a b",
    "ét": "et",
    "x² Ⅷ": "x² ⅷ",
}


def test_clean_campaign(spark):
    assert values(spark, list(CAMPAIGNS), text.clean_campaign("c1")) == list(CAMPAIGNS.values())


def test_campaign_properties_hold_for_any_text(spark):
    pick = random.Random(7)
    parts = ["gclid", "www.google.com", "_", "-", "é", "É", "x", "1", "²", " ", "\xa0", "!", "中",
             "%", "\n"]
    cases = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 9))) for _ in range(500)]
    found = values(spark, cases, text.clean_campaign("c1"))
    for name in found:
        assert name and name == name.lower() and not set("-!%") & set(name)
        assert name == " ".join(name.split())
    plain = [name for name in found if not {"gclid", "wwwgooglecom"} & set(name.split())]
    assert values(spark, plain, text.clean_campaign("c1")) == plain


SOURCE_TEXTS = {
    "": None,
    " \t": None,
    "ABC": "abc",
    " a/b// ": "a/b",
    "a?b=/c": "a",
    "a/?b?c": "a",
    "?a": "",
    "///": "",
    "a b\n": "a b",
}


def test_source_text(spark):
    found = values(spark, list(SOURCE_TEXTS), text.source_text("c1"))
    assert found == list(SOURCE_TEXTS.values())


def test_promo_label(spark):
    cases = [(None, "A"), (" NoPromotionApplied ", "A"), ("X", " A1 "), ("X", None)]
    found = values(spark, cases, text.promo_label("c1", "c2"))
    assert found == ["NoPromotion", "NoPromotion", "A1", "None"]


def test_pricing(spark):
    cases = ["DynamicTest", "TestStatic", "Test", "FooTest\n", None]
    assert values(spark, cases, text.strategy_base("c1")) == [
        "Dynamic", "TestStatic", "", "Foo\n", None]
    assert values(spark, cases, text.is_test("c1")) == [True, False, True, False, None]


def test_contains_ignores_case_and_null(spark):
    cases = ["Émile", "EMILE", None]
    assert values(spark, cases, text.contains("c1", "^é")) == [True, False, False]


def test_joined_key(spark):
    assert values(spark, [("a", None)], text.joined_key("c1", "c2")) == ["a_None"]


DAYS = [dt.date(2021, 5, d) for d in range(16, 26)]


@pytest.mark.parametrize("anchor", list(dates.ANCHORS))
def test_week_start(spark, anchor):
    found = values(spark, [str(d) for d in DAYS], dates.week_start(F.to_date("c1"), anchor))
    first = dates.ANCHORS[anchor]
    assert found == [d - dt.timedelta((d.weekday() - first) % 7) for d in DAYS]


def test_weeks_starting_on_tuesday_end_on_monday(spark):
    found = values(spark, ["2021-05-23", "2021-05-24", "2021-05-25", None],
                   dates.week_start(F.to_date("c1"), "TUE").cast("string"))
    assert found == ["2021-05-18", "2021-05-18", "2021-05-25", None]


def test_week_start_may_keep_the_time(spark):
    column = dates.week_start(dates.parse_moment("c1"), keep_time=True)
    assert values(spark, ["2021-05-23 13:14:15"], column) == [dt.datetime(2021, 5, 17, 13, 14, 15)]


def test_unknown_anchor():
    with pytest.raises(ValueError, match="anchor"):
        dates.week_start("c1", "MONDAY")


def test_week_label_and_back(spark):
    label = dates.week_label(F.to_date("c1"))
    assert values(spark, ["2021-05-24", None], label) == ["2021-05-24/2021-05-30", "NaT"]
    cases = ["2021-05-24/2021-05-30", "2021-05-24", "2021-05-24 10:00:00", "NaT", "x/y", None]
    assert values(spark, cases, dates.read_week("c1")) == [
        dt.datetime(2021, 5, 24), dt.datetime(2021, 5, 24), dt.datetime(2021, 5, 24, 10),
        None, None, None]


def test_lenient_days(spark):
    cases = ["2021-05-03", "2021-5-3", "n/a", "2021-13-01", "2021-05-03 10:00", "2021-05", None]
    day = dt.date(2021, 5, 3)
    assert values(spark, cases, dates.parse_day("c1", strict=False)) == [
        day, day, None, None, None, None, None]
    assert values(spark, ["05/03/2021", "5/3/2021"], dates.parse_day("c1", dates.US_DAY)) == [
        day, day]


@pytest.mark.parametrize("bad", ["n/a", "2021-13-01", "2021-05-03 10:00", "2021-05"])
def test_strict_days_fail_the_job(spark, bad):
    with pytest.raises(PySparkException):
        values(spark, [bad], dates.parse_day("c1"))


def test_safe_div(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (1, 0), (1, -2), (1, NULL) AS t(a, b)")
    found = [r[0] for r in df.select(m.safe_div("a", "b", 100)).collect()]
    assert found == [50.0, 0.0, 0.0, 0.0]
    assert df.select(m.safe_div("a", "b", 1, None)).collect()[1][0] is None
