"""Correlation of columns over the rows where both are present."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.positions import running_total
from weekloom.operators.rollup import quoted
from weekloom.sources.tables import staged

_PAIR = ["a", "b"]
_WIDE = "decimal(38,0)"


def corr(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation matrix: column ``index`` and one column for each of ``columns``."""
    values = corr_pairs(df, columns, method)
    both = values.select(F.col("a").alias("index"), F.col("b").alias("_v"), "value").unionByName(
        values.where("a <> b").select(F.col("b").alias("index"), F.col("a").alias("_v"), "value")
    )
    # A column without values has no pairs but keeps its place.
    places = df.sparkSession.createDataFrame(
        [(c, None, None) for c in columns], "index string, _v string, value double"
    )
    return both.unionByName(places).groupBy("index").agg(
        *(F.max(F.when(F.col("_v") == c, F.col("value"))).alias(c) for c in columns)
    )


def melt(matrix: DataFrame, index: str = "index") -> DataFrame:
    """Matrix to rows ``index, variable, value``."""
    columns = [c for c in matrix.columns if c != index]
    return matrix.unpivot(quoted(index), [quoted(c) for c in columns], "variable", "value")


def corr_pairs(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Columns ``a``, ``b`` and ``value`` for each unordered pair, a column with itself too."""
    if method not in _METHODS:
        raise ValueError(f"method must be one of {sorted(_METHODS)}, got {method!r}")
    places = {f"_{i}": c for i, c in enumerate(columns)}
    doubles = {place: quoted(c).cast("double") for place, c in places.items()}
    numbers = df.select(*(F.when(~F.isnan(d), d).alias(place) for place, d in doubles.items()))
    name = F.create_map(*(F.lit(part) for place in places.items() for part in place))
    found = _METHODS[method](numbers, list(places))
    return found.select(*(name[F.col(side)].alias(side) for side in _PAIR), "value")


def _pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairs in one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    sums = ("regr_sxy", "regr_sxx", "regr_syy")
    wide = df.agg(
        *(getattr(F, f)(b, a).alias(f"{f}_{i}") for i, (a, b) in enumerate(pairs) for f in sums)
    )
    rows = F.array(
        *(
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _coefficient(i).alias("value"))
            for i, (a, b) in enumerate(pairs)
        )
    )
    return wide.select(F.inline(rows))


def _coefficient(i: int) -> Column:
    """Covariance over both deviations; NULL for a constant column."""
    spread = F.sqrt(F.col(f"regr_sxx_{i}")) * F.sqrt(F.col(f"regr_syy_{i}"))
    return _clip(F.try_divide(F.col(f"regr_sxy_{i}"), spread))


def _clip(value: Column) -> Column:
    """Rounding aside, a coefficient lies between -1 and 1; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)))


def _points(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Distinct points of each pair of columns with the number of rows on them.

    They are read several times, so they are written once.
    """
    rows = F.array(
        *(
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")
            )
            for a, b in pairs
        )
    )
    points = (
        df.select(F.inline(rows))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy(*_PAIR, "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return staged(points, "points")


def _average_ranks(values: DataFrame, groups: list[str], axis: str) -> DataFrame:
    """Rank of each value of an axis within its group, ties sharing the average of their places.

    ``values`` has a row for each different value, with the number of its rows in ``n``.
    """
    placed = running_total(values, groups, axis, "n", "_before")
    rank = F.col("_before") + (F.col("n") + 1) / F.lit(2.0)
    return placed.select(*groups, axis, rank.alias(f"r{axis}"))


def _spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of average ranks over the rows where both columns are present.

    Columns without missing values keep their ranks in every pair: each is ranked once, the ranks stand beside
    the rows, and all pairs are one pass over them.  Only a pair in which a value is missing has
    ranks of its own.
    """
    rows = staged(df, "numbers")
    counts = rows.agg(F.count(F.lit(1)).alias("_all"), *(F.count(c).alias(c) for c in columns)).first()
    whole = [c for c in columns if counts["_all"] and counts[c] == counts["_all"]]
    apart = [p for p in combinations_with_replacement(columns, 2) if not set(p) <= set(whole)]
    found = [_shared_ranks(rows, whole, counts["_all"])] if whole else []
    if apart:
        found.append(_ranks_of_pairs(rows, apart))
    return reduce(DataFrame.unionByName, found)


def _shared_ranks(rows: DataFrame, columns: list[str], count: int) -> DataFrame:
    """Pearson over ranks of columns without missing values, whose mean is known beforehand.

    Each row is copied once for each column to be counted by value.  A rank table has a value once, so
    a join with it adds no rows, and a value that many rows share is split by adaptive execution.
    """
    cells = F.array(*(F.struct(F.lit(i).alias("place"), F.col(c).alias("x")) for i, c in enumerate(columns)))
    values = rows.select(F.inline(cells)).groupBy("place", "x").agg(F.count(F.lit(1)).alias("n"))
    ranks = staged(_average_ranks(values, ["place"], "x"), "ranks")  # read once for each column
    ranked = rows.select(*columns)
    for i, c in enumerate(columns):
        own = ranks.where(F.col("place") == i).select(F.col("x").alias(c), F.col("rx").alias(f"r{c}"))
        ranked = ranked.join(own, c)
    centred = ranked.select(*((F.col(f"r{c}") - F.lit((count + 1) / 2)).alias(c) for c in columns))
    pairs = list(combinations_with_replacement(columns, 2))
    sums = centred.agg(*(F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in pairs))

    def value(a: str, b: str) -> Column:
        spread = F.sqrt(F.col(f"{a}*{a}")) * F.sqrt(F.col(f"{b}*{b}"))
        return F.when(spread > 0, F.col(f"{a}*{b}") / spread)

    cells = (F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _clip(value(a, b)).alias("value")) for a, b in pairs)
    return sums.select(F.inline(F.array(*cells)))


def _ranks_of_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """As :func:`_shared_ranks` for pairs with missing values, on distinct points with their row counts."""
    points = _points(df, pairs)
    ranked = points
    for axis in ("x", "y"):
        values = points.groupBy(*_PAIR, axis).agg(F.sum("n").alias("n"))
        ranked = ranked.join(_average_ranks(values, _PAIR, axis), [*_PAIR, axis])
    weight = F.col("n").cast("double")
    sums = ranked.groupBy(*_PAIR).agg(
        F.sum("n").cast("double").alias("w"),
        F.sum(weight * F.col("rx") * F.col("ry")).alias("xy"),
        F.sum(weight * F.col("rx") * F.col("rx")).alias("xx"),
        F.sum(weight * F.col("ry") * F.col("ry")).alias("yy"),
    )
    # Ranks with shared places always sum to w (w + 1) / 2.
    middle = F.col("w") * (F.col("w") + 1) * (F.col("w") + 1) / 4
    spread = (F.col("xx") - middle) * (F.col("yy") - middle)
    value = F.when(spread > 0, (F.col("xy") - middle) / F.sqrt(spread))
    return sums.select(*_PAIR, _clip(value).alias("value"))


def _kendall(df: DataFrame, columns: list[str]) -> DataFrame:
    """Tau-b.  Pairs of rows are counted, never formed; see :func:`_discordant`."""
    points = _points(df, list(combinations(columns, 2)))
    ties_x = _tied(points.groupBy(*_PAIR, "x").agg(F.sum("n").alias("n")), "tx")
    ties_y = _tied(points.groupBy(*_PAIR, "y").agg(F.sum("n").alias("n")), "ty")
    both = points.groupBy(*_PAIR).agg(
        F.sum(_couples("n")).alias("txy"), _couples(F.sum("n")).alias("all")
    )
    parts = (
        both.join(F.broadcast(ties_x), _PAIR)
        .join(F.broadcast(ties_y), _PAIR)
        .join(F.broadcast(_discordant(points)), _PAIR, "left")
        .fillna(0, ["dis"])
    )
    num = F.col("all") - F.col("tx") - F.col("ty") + F.col("txy") - F.col("dis") * 2
    left = (F.col("all") - F.col("tx")).cast("double")
    right = (F.col("all") - F.col("ty")).cast("double")
    value = F.when((left > 0) & (right > 0), num.cast("double") / F.sqrt(left) / F.sqrt(right))
    own = df.agg(*(F.max(c).alias(c) for c in columns)).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("a"),
                        F.lit(c).alias("b"),
                        F.when(F.col(c).isNotNull(), 1.0).alias("value"),
                    )
                    for c in columns
                )
            )
        )
    )
    return parts.select(*_PAIR, value.alias("value")).unionByName(own)


def _couples(n: Column | str) -> Column:
    """Number of pairs among ``n`` rows."""
    n = (F.col(n) if isinstance(n, str) else n).cast("decimal(18,0)")
    return (n * (n - 1) / 2).cast(_WIDE)


def _tied(values: DataFrame, out: str) -> DataFrame:
    return values.groupBy(*_PAIR).agg(F.sum(_couples("n")).alias(out))


def _discordant(points: DataFrame) -> DataFrame:
    """Number of pairs of rows that x and y put in opposite order.

    The points are cut into ranges of the order by x, then y, and into ranges of the order by y, then
    x.  Equal values of one axis are in the order of the other, so a pair of points is discordant if
    and only if the two orders differ on it, and a value shared by many points can be cut anywhere.

    Every pair of points lies in one range of the first order, or else in one of the second, or
    else apart in both.  The first two kinds are counted inside the ranges, each by one task that
    sorts; the third from the number of rows in each pair of ranges.
    """
    by_x, by_y = "_by_x", "_by_y"
    ranged = staged(points.repartitionByRange(*_PAIR, "x", "y").withColumn(by_x, F.spark_partition_id()), "ranges")
    ranged = staged(ranged.repartitionByRange(*_PAIR, "y", "x").withColumn(by_y, F.spark_partition_id()), "ranges")
    schema = "a string, b string, dis decimal(38,0)"
    keyed = ranged.select(*_PAIR, by_x, by_y, "x", "y", "n")
    inside = keyed.groupBy(*_PAIR, by_x).applyInArrow(_inversions("x", "y", None), schema)
    across = keyed.groupBy(*_PAIR, by_y).applyInArrow(_inversions("x", "y", by_x), schema)
    cells = ranged.groupBy(*_PAIR, by_x, by_y).agg(F.sum("n").alias("n"))
    wide = cells.select(*_PAIR, by_x).distinct().join(cells.select(*_PAIR, by_y).distinct(), _PAIR)
    full = wide.join(cells, [*_PAIR, by_x, by_y], "left").fillna(0, ["n"])
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    later = before(Window.partitionBy(*_PAIR, by_x).orderBy(F.col(by_y).desc()))
    earlier = before(Window.partitionBy(*_PAIR, by_y).orderBy(by_x))
    full = full.withColumn("_above", F.coalesce(F.sum("n").over(later), F.lit(0)))
    full = full.withColumn("_crossed", F.coalesce(F.sum("_above").over(earlier), F.lit(0)))
    product = F.col("n").cast("decimal(18,0)") * F.col("_crossed").cast("decimal(18,0)")
    apart = full.groupBy(*_PAIR).agg(F.sum(product.cast(_WIDE)).cast(_WIDE).alias("dis"))
    every = inside.unionByName(across).unionByName(apart)
    return every.groupBy(*_PAIR).agg(F.sum("dis").cast(_WIDE).alias("dis"))


def _inversions(x: str, y: str, other: str | None):
    """Count the discordant rows among the points of a group, of two ranges ``other`` if given.

    Points are numbered by (y, x), and taken in the order of (x, y), or of ``other``.  Of two points
    whose numbers first differ at some binary digit, the earlier has the 1 if they are discordant; so
    for each digit a running sum over the points that agree on all higher digits counts them.
    """

    def count(group: pa.Table) -> pa.Table:
        xs, ys, n = (group.column(c).to_numpy() for c in (x, y, "n"))
        number = np.empty(len(n), np.int64)
        number[np.lexsort((xs, ys))] = np.arange(len(n))
        if other is None:
            place = np.empty(len(n), np.int64)
            place[np.lexsort((ys, xs))] = np.arange(len(n))
        else:
            place = group.column(other).to_numpy().astype(np.int64)
        # points of one place are no pair: the smaller number first
        order = np.lexsort((number, place))
        number, n = number[order], n[order].astype(np.int64)
        total, digits = 0, int(len(n)).bit_length()
        for digit in range(digits):
            row = np.argsort(number >> (digit + 1), kind="stable")
            bit, weight = (number[row] >> digit) & 1, n[row]
            higher = number[row] >> (digit + 1)
            ones = np.cumsum(weight * bit)
            start = np.flatnonzero(np.append(True, higher[1:] != higher[:-1]))
            base = np.append(0, ones)[start]
            before = ones - np.repeat(base, np.diff(np.append(start, len(row))))
            # in two parts, as a product of two counts may not fit in 64 bits
            zeros = weight * (1 - bit)
            total += (int(zeros @ (before >> 20)) << 20) + int(zeros @ (before & ((1 << 20) - 1)))
        return pa.table(
            {
                "a": group.column("a")[:1],
                "b": group.column("b")[:1],
                "dis": pa.array([Decimal(total)], pa.decimal128(38, 0)),
            }
        )

    return count


_METHODS = {"pearson": _pearson, "spearman": _spearman, "kendall": _kendall}
