"""Statistics against pandas and brute force, with groups cut into ranges and without."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from weekloom.operators import correlate, explore, forecast, positions, quantiles

COLUMNS = ["a", "b", "c"]


def sample(rows=400):
    pick = random.Random(3)
    data = []
    for _ in range(rows):
        a = pick.choice([None, 7.0, float(pick.randint(0, 40)), pick.random() * 9])
        b = 7.0 if pick.random() < 0.35 else float(pick.randint(-5, 60))
        c = None if pick.random() < 0.1 else (a or 0.0) * 2 + pick.randint(0, 9)
        data.append((a, b, c))
    return data


RANGES = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture(params=[False, True], ids=["united", "apart"])
def cut(request, spark):
    """Small ranges united, as adaptive execution does it, or kept apart."""
    before = {name: spark.conf.get(name) for name in RANGES}
    for name, value in RANGES.items():
        if request.param:
            spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(sample(), "a double, b double, c double").repartition(5).cache()


def as_dict(matrix):
    return {
        (r["index"], c): r[c] for r in matrix.collect() for c in matrix.columns if c != "index"
    }


def tau_b(x, y):
    dx = [np.sign(p - q) for p, q in itertools.combinations(x, 2)]
    dy = [np.sign(p - q) for p, q in itertools.combinations(y, 2)]
    score = sum(a * b for a, b in zip(dx, dy, strict=True))
    return score / math.sqrt(sum(a != 0 for a in dx)) / math.sqrt(sum(b != 0 for b in dy))


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations(frame, cut, method):
    pdf = pd.DataFrame(sample(), columns=COLUMNS).astype(float)
    found = as_dict(correlate.corr(frame, COLUMNS, method))
    for a, b in itertools.product(COLUMNS, repeat=2):
        both = pdf[[a, b]].dropna() if a != b else pdf[[a]].dropna()
        x, y = both.iloc[:, 0], both.iloc[:, -1]
        if a == b:
            expected = 1.0
        elif method == "kendall":
            expected = tau_b(list(x), list(y))
        elif method == "spearman":
            expected = x.rank().corr(y.rank())
        else:
            expected = x.corr(y)
        assert found[a, b] == pytest.approx(expected, abs=1e-12)
        assert found[a, b] == found[b, a]


def test_correlation_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (2.0, 5.0, None), (4.0, 5.0, None)], "a double, b double, c double")
    for method in ("pearson", "spearman", "kendall"):
        found = as_dict(correlate.corr(df, COLUMNS, method))
        assert found["a", "a"] == pytest.approx(1.0)
        assert found["a", "b"] is None
        assert found["a", "c"] is None
        assert found["c", "c"] is None


def test_complete_columns_are_ranked_once(spark, monkeypatch):
    """Only pairs in which a value is missing get ranks of their own."""
    asked = []
    own = correlate._ranks_of_pairs
    monkeypatch.setattr(correlate, "_ranks_of_pairs", lambda df, pairs: asked.append(pairs) or own(df, pairs))
    data = [(float(i % 7), float(i * i % 11), None if i == 3 else float(i)) for i in range(50)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    expected = pd.DataFrame(data, columns=COLUMNS).astype(float)
    found = as_dict(correlate.corr(df, COLUMNS, "spearman"))
    assert [len(pairs) for pairs in asked] == [3]
    for a, b in itertools.combinations(COLUMNS, 2):
        both = expected[[a, b]].dropna()
        assert found[a, b] == pytest.approx(both[a].rank().corr(both[b].rank()), abs=1e-12)
    asked.clear()
    correlate.corr(df, ["a", "b"], "spearman")
    assert asked == []


@pytest.mark.parametrize("apart", [False, True])
def test_inversions_of_one_range(apart):
    draw = random.Random(4)
    for size in (1, 2, 3, 17, 200):
        points = sorted({(float(draw.randint(0, 12)), float(draw.randint(0, 12))) for _ in range(size)})
        draw.shuffle(points)
        n = [draw.choice([1, 2, 10**9]) for _ in points]
        # ranges in the order of x, as cutting gives them
        place = [int(x) // 3 for x, _ in points]
        table = pa.table({
            "a": ["a"] * len(n), "b": ["b"] * len(n), "x": [p[0] for p in points],
            "y": [p[1] for p in points], "n": n, "range": place,
        })
        found = correlate._inversions("x", "y", "range" if apart else None)(table)
        expected = sum(
            n[i] * n[j]
            for i, j in itertools.combinations(range(len(n)), 2)
            if (points[i][0] - points[j][0]) * (points[i][1] - points[j][1]) < 0
            and (not apart or place[i] != place[j])
        )
        assert found.to_pylist() == [{"a": "a", "b": "b", "dis": expected}]


def test_unknown_method(frame):
    with pytest.raises(ValueError, match="method"):
        correlate.corr(frame, COLUMNS, "cosine")


def test_melt(frame):
    long = correlate.melt(correlate.corr(frame, COLUMNS))
    assert long.columns == ["index", "variable", "value"]
    assert long.count() == 9


def test_describe(frame, cut):
    pdf = pd.DataFrame(sample(), columns=COLUMNS).astype(float).describe()
    rows = {r["variable"]: r for r in explore.describe(frame).collect()}
    names = {"p25": "25%", "p50": "50%", "p75": "75%"}
    for c in COLUMNS:
        for stat in ("count", "mean", "std", "min", "p25", "p50", "p75", "max"):
            expected = pdf.loc[names.get(stat, stat), c]
            assert rows[c][stat] == pytest.approx(expected, rel=1e-12)


def test_describe_of_one_and_no_value(spark):
    df = spark.createDataFrame([(3, None)], "a int, b int")
    rows = {r["variable"]: r.asDict() for r in explore.describe(df).collect()}
    assert rows["a"] == dict(variable="a", count=1, mean=3.0, std=None, min=3.0, p25=3.0,
                             p50=3.0, p75=3.0, max=3.0)
    assert rows["b"]["count"] == 0
    assert rows["b"]["p50"] is None


def test_describe_times(spark):
    days = [dt.date(2021, 5, d) for d in (1, 2, 4, 9)]
    df = spark.createDataFrame([(d,) for d in days], "Week date")
    row = explore.describe_times(df).collect()[0]
    expected = pd.DataFrame({"Week": pd.to_datetime(days)}).describe()["Week"]
    for stat, name in {"mean": "mean", "min": "min", "p25": "25%", "p75": "75%"}.items():
        assert row[stat] == expected[name].to_pydatetime()


def test_running_total_does_not_depend_on_ranges(spark, cut):
    df = spark.range(5000).selectExpr("id % 3 AS g", "id * 7 % 5003 AS x", "id % 11 AS w")
    ranged = positions.with_ranges(df, ["g"], "x")
    assert (ranged.select(positions.RANGE).distinct().count() > 10) == cut
    found = positions.running_total(df, ["g"], "x", "w", "s").toPandas()
    expected = df.toPandas().sort_values(["g", "x"])
    expected["s"] = expected.groupby("g")["w"].cumsum() - expected["w"]
    found = found.sort_values(["g", "x"])[["g", "x", "w", "s"]]
    assert found.to_numpy().tolist() == expected.to_numpy().tolist()


def test_names_with_dots(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 5.0, "p.q"), (2, 1.0, 4.0, "r"), (3, 0.5, 9.0, "p.q")], "`a.x` int, b double, c double, k string")
    rows = {r["variable"]: r for r in explore.describe(df).collect()}
    assert set(rows) == {"a.x", "b", "c"} and rows["a.x"]["p50"] == 2.0
    for method in ("pearson", "spearman", "kendall"):
        found = as_dict(correlate.corr(df, ["a.x", "b"], method))
        assert found["a.x", "a.x"] == pytest.approx(1.0) and found["a.x", "b"] < -0.9
    assert correlate.melt(correlate.corr(df, ["a.x", "b"])).where("variable = 'a.x'").count() == 2
    assert explore.xy_series(df, "a.x", "b").columns == ["a.x", "b"]
    assert explore.scatter_matrix(df, ["a.x", "b"]).count() == 12
    wide = explore.describe(explore.pivot(df, "b", "k", "c"))
    assert {r["variable"]: r["count"] for r in wide.collect()} == {"b": 3, "p.q": 2, "r": 1}


# -- forecasts ---------------------------------------------------------------------------


def weekly(spark, count, value, step=7):
    start = dt.date(2018, 1, 1)
    data = [(start + dt.timedelta(step * i), value(step * i)) for i in range(count)]
    return spark.createDataFrame(data, "Week date, y double")


@pytest.mark.parametrize("model", [forecast.forecast, forecast.forecast_trend])
def test_a_line_is_found_again(spark, model):
    df = weekly(spark, 200, lambda d: 3.0 + 0.5 * d)
    out = model(df, "y", 30).orderBy("ds").collect()
    assert len(out) == 230
    assert out[-1]["ds"] - out[199]["ds"] == dt.timedelta(30)
    for row in out:
        days = (row["ds"] - dt.date(2018, 1, 1)).days
        assert row["yhat"] == pytest.approx(3.0 + 0.5 * days, rel=1e-6)
        assert row["yhat_lower"] <= row["yhat"] <= row["yhat_upper"]


def test_waves_are_parts_of_the_forecast(spark):
    wave = lambda d: 100 + 10 * math.sin(2 * math.pi * d / 365.25)
    df = weekly(spark, 200, wave)
    out = forecast.forecast(df, "y", 60, components=True).orderBy("ds").collect()
    for row in out[200:]:
        days = (row["ds"] - dt.date(2018, 1, 1)).days
        assert row["yhat"] == pytest.approx(wave(days), abs=1.5)
        assert row["yhat"] == pytest.approx(row["trend"] + row["yearly"] + row["weekly"])
        assert row["weekly"] == 0.0
    daily = weekly(spark, 100, lambda d: float(d % 7), step=1)
    parts = forecast.forecast(daily, "y", 7, components=True).collect()
    assert max(abs(r["weekly"]) for r in parts) > 1
    assert all(r["yearly"] == 0.0 for r in parts)


def test_one_forecast_per_series(spark):
    df = spark.createDataFrame(
        [(s, dt.date(2021, 1, 4) + dt.timedelta(7 * i), f * i) for s, f in (("u", 1.0), ("v", -2.0))
         for i in range(20)] + [("w", dt.date(2021, 1, 4), 5.0), ("x", dt.date(2021, 1, 4), None)],
        "s string, Week date, y double")
    for model in (forecast.forecast, forecast.forecast_trend):
        out = model(df, "y", 7, series=["s"])
        last = {r["s"]: r["yhat"] for r in out.orderBy("ds").collect()}
        assert last["u"] == pytest.approx(20.0, rel=1e-6)
        assert last["v"] == pytest.approx(-40.0, rel=1e-6)
        assert last["w"] == pytest.approx(5.0)
        assert "x" not in last
    with pytest.raises(ValueError, match="horizon"):
        forecast.forecast(df, "y", 0)


def test_rows_of_one_day_weigh_together(spark):
    one = spark.createDataFrame(
        [(dt.date(2021, 1, 1 + i), float(i * i % 5)) for i in range(20)], "Week date, y double")
    twice = one.unionAll(one)
    a = forecast.forecast(one, "y", 5).orderBy("ds").collect()
    b = forecast.forecast(twice, "y", 5).orderBy("ds").collect()
    assert [r["ds"] for r in a] == [r["ds"] for r in b]


def test_quartiles_do_not_depend_on_the_sketch(spark, monkeypatch):
    """Whatever the sketch says: bounds that miss a place are drawn again."""
    draw = random.Random(6)
    rows = [
        (draw.random(), float(draw.randint(0, 3)), draw.choice([1.0, 1.0, 1.0, draw.random()]), 5.0,
         draw.choice([None, -draw.random(), 1e300 * draw.random()]), math.inf if i % 9 == 0 else -float(i))
        for i in range(3000)
    ]
    names = list("abcdef")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    monkeypatch.setattr(quantiles, "SKETCH", 8)  # ranks off by a third of the rows
    found = {r["variable"]: r for r in explore.describe(df).collect()}
    pdf = pd.DataFrame(rows, columns=names)
    for name in names:
        column = pdf[name].dropna().astype(float).to_numpy()
        for label, q in explore.QUARTILES.items():
            assert found[name][label] == pytest.approx(np.quantile(column, q), rel=1e-12), (name, q)
