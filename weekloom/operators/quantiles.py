"""Exact quantiles of many columns from a sketch and a sort of the few values around each quantile.

Columns are read as rows ``place, x``, so plans stay small however many columns there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a KLL sketch; its ranks are wrong by about 0.04 % of the rows.
SKETCH = 16_384
#: What is sorted on either side of a quantile, as a share of the rows.
SLACK = 0.0015


def around(values: str, qs: Sequence[float], slack: float = SLACK) -> Column:
    """Aggregate: values of a sketch just below and just above each quantile."""
    sides = [max(0.0, min(1.0, q + side)) for q in qs for side in (-slack, slack)]
    shares = ", ".join(f"{side!r}D" for side in sides)
    return F.expr(f"kll_sketch_get_quantile_double(kll_sketch_agg_double({values}, {SKETCH}), array({shares}))")


def quantiles(
    values: DataFrame,
    qs: Sequence[float],
    counts: Mapping[int, int],
    bounds: Mapping[int, Sequence[float]],
    slack: float = SLACK,
) -> dict[tuple[int, float], float]:
    """The exact value at each quantile of each place, interpolated linearly between neighbours.

    ``values`` has ``place`` (an int) and ``x``, without nulls; ``counts`` are the rows of each place and ``bounds``
    the values of :func:`around`.  One pass counts the rows between the bounds and the different
    values inside them, combined before the shuffle.  Whether a quantile's neighbours are inside is then known
    exactly; where they are not, that place is done again with bounds further apart.
    """
    spark = values.sparkSession
    targets = [
        (place, q, at)
        for place, rows in counts.items()
        for q in qs
        for at in {math.floor((rows - 1) * q), math.ceil((rows - 1) * q)}
    ]
    cuts = spark.createDataFrame([(p, list(b)) for p, b in bounds.items()], "place int, cuts array<double>")
    x, size = F.col("x"), 2 * len(qs)
    cut = [F.get("cuts", F.lit(i)) for i in range(size)]
    zone = sum(((x > c).cast("int") for c in cut), F.lit(0))
    inside = F.lit(False)
    for low, high in zip(cut[::2], cut[1::2], strict=True):
        inside = inside | x.between(low, high)
    counted = (
        values.join(F.broadcast(cuts), "place")
        .groupBy("place", zone.alias("zone"), F.when(inside, x).alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # values outside come before the bound that ends their zone, and NULLs first
    upto = F.sum("n").over(Window.partitionBy("place").orderBy("zone", "x"))
    wanted = spark.createDataFrame(targets, "place int, q double, at long")
    here = (F.col("upto") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("upto"))
    placed = counted.withColumn("upto", upto).join(F.broadcast(wanted), "place").where(here)
    neighbours = {(r["place"], r["q"], r["at"]): r["x"] for r in placed.select("place", "q", "at", "x").collect()}
    missed = {place for (place, _, _), x in neighbours.items() if x is None}
    out = {}
    for place, rows in counts.items():
        for q in qs if place not in missed else ():
            at = (rows - 1) * q
            low, high = (neighbours[place, q, f(at)] for f in (math.floor, math.ceil))
            out[place, q] = low if low == high else low + (high - low) * (at - math.floor(at))
    if missed:
        again = values.where(F.col("place").isin(*missed))
        wider = again.groupBy("place").agg(around("x", qs, slack * 8).alias("cuts")).collect()
        left = {place: counts[place] for place in missed}
        out |= quantiles(again, qs, left, {r["place"]: r["cuts"] for r in wider}, slack * 8)
    return out
