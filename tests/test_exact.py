"""Sums of doubles: the nearest double to the true sum, in any order of rows."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from weekloom.functions import measures as m
from weekloom.operators import exact
from weekloom.operators.rollup import rollup


def bits(x):
    return None if x is None else struct.pack("<d", x)


def nearest(values):
    """The double nearest to the sum of finite values; infinite beyond the greatest."""
    try:
        return float(sum(map(Fraction, values)))
    except OverflowError:
        return math.copysign(math.inf, sum(map(Fraction, values)))


def draw_values(draw, kind, n):
    if kind == "money":
        return [round(draw.uniform(-1e5, 1e5), 2) for _ in range(n)]
    if kind == "wide":
        return [draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(n)]
    if kind == "cancel":
        half = [draw.uniform(-1, 1) * 2.0 ** draw.randint(-200, 200) for _ in range(n // 2)]
        return half + [-x for x in half] + [1e-20]
    if kind == "bits":
        found = (struct.unpack("<d", struct.pack("<Q", draw.getrandbits(64)))[0] for _ in range(n))
        return [x for x in found if math.isfinite(x)]
    return [draw.choice([5e-324, -5e-324, 2.0**-1022, 2.0**-1060, 3e-310]) for _ in range(n)]


KINDS = ("money", "wide", "cancel", "bits", "tiny")


def test_sums_are_the_nearest_double(spark):
    draw = random.Random(11)
    groups = {f"{kind}{n}": draw_values(draw, kind, n) for kind in KINDS for n in (1, 2, 3, 40, 300)}
    rows = [(k, x) for k, values in groups.items() for x in values]
    found = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(5 + seed)
        out = rollup(df, ["k"], {"s": m.total("v"), "n": m.count("v"), "a": m.mean("v")}, exact=True)
        found.append({r["k"]: (bits(r["s"]), r["n"], bits(r["a"])) for r in out.collect()})
    assert found[0] == found[1]
    for k, values in groups.items():
        total = nearest(values)
        assert found[0][k] == (bits(total), len(values), bits(total / len(values))), k


def test_amounts_of_very_different_size(spark):
    df = spark.createDataFrame([(1e30,), (1e-20,), (-1e30,), (0.25,), (-0.25,)], "v double")
    assert rollup(df, [], {"s": m.total("v")}, exact=True).first()[0] == 1e-20


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([math.inf, 1.0, 1e308], math.inf),
        ([-math.inf, 5e-324], -math.inf),
        ([math.inf, -math.inf, 2.0], math.nan),
        ([1e308, 1e308], math.inf),
        ([-1.7e308, -1.7e308], -math.inf),
        ([1e308, 1e308, -1e308], 1e308),
        ([math.nan, 2.5, None], 2.5),
        ([0.1] * 10, 1.0),
        ([0.0, -0.0], 0.0),
    ],
)
def test_special_values(spark, values, expected):
    df = spark.createDataFrame([(x,) for x in values], "v double")
    found = rollup(df, [], {"s": m.total("v")}, exact=True).first()[0]
    assert found == expected or (math.isnan(found) and math.isnan(expected))


def test_nothing_sums_to_zero_and_has_no_mean(spark):
    df = spark.createDataFrame([("a", None), ("b", math.nan), ("c", 1.5)], "k string, v double")
    measures = {"s": m.total("v"), "a": m.mean("v"), "n": m.count("k")}
    found = {r["k"]: (r["s"], r["a"], r["n"]) for r in rollup(df, ["k"], measures, exact=True).collect()}
    assert found == {"a": (0.0, None, 1), "b": (0.0, None, 1), "c": (1.5, 1.5, 1)}
    none = rollup(df.where("false"), [], measures, exact=True).first()
    assert tuple(none) == (0.0, None, 0)
    assert rollup(df.where("false"), ["k"], measures, exact=True).count() == 0


def test_other_measures_beside_exact_sums(spark):
    """A value beyond the usual digits makes rows beside its own, which nothing else may count."""
    draw = random.Random(3)
    rows = [
        (draw.choice(["a", "b", None]), draw.choice([1e40, 0.1, 1e-40, None]), draw.randint(1, 9),
         draw.choice([1, 2, 3, None]), draw.choice([True, False, None]))
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, "k string, v double, i int, d int, b boolean")
    df = df.withColumn("m", F.expr("CAST(i AS DECIMAL(18,4)) / 8")).withColumn("f", F.expr("CAST(v / 1e20 AS FLOAT)"))
    measures = {
        "v": m.total("v"), "f": m.total("f"), "i": m.total("i"), "m": m.total("m"), "am": m.mean("m"),
        "n": m.count("i"), "d": m.distinct("d"), "b": m.total("b"),
    }
    got = rollup(df, ["k"], measures, nullable=["k"], exact=True)
    plain = rollup(df, ["k"], measures, nullable=["k"])
    assert got.dtypes == plain.dtypes
    exactly = [c for c in measures if c not in ("v", "f")]
    assert sorted(got.select("k", *exactly).collect(), key=str) == sorted(
        plain.select("k", *exactly).collect(), key=str
    )
    for row in got.collect():
        mine = [r[1] for r in rows if r[0] == row["k"] and r[1] is not None]
        assert row["v"] == nearest(mine)


def test_no_group_keeps_its_rows(spark):
    """However many rows lie outside the usual digits, a group sums a row for each slot at most."""
    df = spark.range(20_000).select(F.expr("id % 2").alias("k"), F.expr("1e-30 * (id + 1)").alias("v"))
    out = exact.grouped(df, ["k"], {"s": m.total("v")})
    assert {r["k"]: r["s"] for r in out.collect()} == {
        k: nearest([1e-30 * (i + 1) for i in range(k, 20_000, 2)]) for k in (0, 1)
    }
    slots = exact._split(df, ["v"]).selectExpr("k", "inline(_tails)").groupBy("k", "slot").count()
    assert slots.count() <= 2 * 6
