"""Exploration of any table: statistics, pivots, filters and plot data."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions import measures as m
from weekloom.functions import text
from weekloom.operators import quantiles
from weekloom.operators.rollup import quoted, require
from weekloom.sources.tables import staged

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
STATISTICS = ("mean", "std", "min", *QUARTILES, "max")
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def time_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, a row per numeric column.

    Quartiles interpolate linearly between neighbours.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    return _describe([quoted(n).cast("double") for n in names], names, df)


def describe_times(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """As :func:`describe` for dates and timestamps, without a deviation."""
    names = list(columns) if columns is not None else time_columns(df)
    epoch = F.expr(EPOCH)
    numbers = [
        F.timestamp_diff("MICROSECOND", epoch, quoted(n).cast("timestamp_ntz")).cast("double")
        for n in names
    ]
    back = {
        c: F.timestamp_add("MICROSECOND", F.round(c).cast("bigint"), epoch)
        for c in ("mean", "min", *QUARTILES, "max")
    }
    return _describe(numbers, names, df).drop("std").withColumns(back)


def _describe(numbers: Sequence[Column], names: Sequence[str], df: DataFrame) -> DataFrame:
    """Statistics of the columns ``numbers`` of ``df`` under the given names.

    Two passes run while the result is built and bring a few numbers for each column: the first takes
    the plain statistics and a quantile sketch, the second counts, and sorts the values around each quartile
    only.  Nothing is stored; a table that is costly to compute should be stored first.
    """
    qs = list(QUARTILES.values())
    spark = df.sparkSession
    places = dict(enumerate(names))
    schema = "variable string, count long, " + ", ".join(f"{c} double" for c in STATISTICS)
    rows = []
    if places:
        cells = (F.struct(F.lit(i).alias("place"), x.alias("x")) for i, x in enumerate(numbers))
        values = df.select(F.inline(F.array(*cells))).where(F.col("x").isNotNull() & ~F.isnan("x"))
        stats = values.groupBy("place").agg(
            F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
            F.min("x").alias("min"), F.max("x").alias("max"), quantiles.around("x", qs).alias("cuts"),
        )
        found = {r["place"]: r for r in stats.collect()}
        counts = {place: r["count"] for place, r in found.items()}
        exact = quantiles.quantiles(values, qs, counts, {p: r["cuts"] for p, r in found.items()})
        for place, name in places.items():
            r = found.get(place)
            if r is None:
                rows.append((name, 0, *[None] * len(STATISTICS)))
            else:
                quartiles = (exact[place, q] for q in qs)
                rows.append((name, r["count"], r["mean"], r["std"], r["min"], *quartiles, r["max"]))
    return spark.createDataFrame(rows, schema)


def pivot(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    how: str = "sum",
    values: Sequence[object] | None = None,
) -> DataFrame:
    """Table of ``how`` (sum, mean, max or min) of ``value`` by ``row`` and ``column``.

    Rows without a key are left out and missing cells are NULL.  A cell holding NULLs only is
    0 for sum; for the others it counts as missing, and a row or column of such cells goes.
    ``row`` and ``column`` may be the same.

    With ``values``, the table has a column for each of them and nothing runs while it is built.
    Otherwise the columns are those of the data: the cells are computed and stored in one job, and
    both the names of the columns and the table are read from there.  More columns than
    ``spark.sql.pivotMaxValues`` (10,000 unless set) are an error, as nobody could read them.
    """
    kind = df.schema[value].dataType
    if how in ("sum", "mean"):
        cell = m.aggregate(m.Measure(how, value), kind)
    elif how in ("max", "min"):
        cell = getattr(F, how)(quoted(value))
    else:
        raise ValueError(f"unknown aggregation {how!r}")
    # a key that comes twice is grouped by once
    keys = [quoted(row).alias("_row"), *([quoted(column).alias("_column")] if column != row else [])]
    cells = require(df, [row, column]).groupBy(*keys).agg(cell.alias("_cell"))
    name = F.col("_row" if column == row else "_column").cast("string")
    cells = cells.where(F.col("_cell").isNotNull()).withColumn("_column", name)
    if values is None:
        cells = staged(cells, "cells")
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = cells.select("_column").distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{column!r} has more than {most} values, too many for columns")
        values = sorted(r["_column"] for r in found)
    table = cells.groupBy("_row").pivot("_column", [str(v) for v in values]).agg(F.max("_cell"))
    return table.withColumnRenamed("_row", row)


def contains(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text matches the pattern, ignoring case; all rows for an empty pattern."""
    return df.where(text.contains(quoted(column), pattern)) if pattern else df


def xy_series(df: DataFrame, x: str, y: str) -> DataFrame:
    """Two columns to plot against each other, with the week where there is one."""
    names = dict.fromkeys([*(["Week"] if "Week" in df.columns else []), x, y])
    return df.select(*map(quoted, names))


def scatter_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row once for each ordered pair of columns.  Done row by row, without a shuffle."""
    if len(columns) < 2:
        raise ValueError("a scatter matrix needs at least two columns")
    number: dict[str, Column] = {c: quoted(c).cast("double") for c in columns}
    pairs = F.array(
        *(
            F.struct(
                F.lit(a).alias("x_var"),
                F.lit(b).alias("y_var"),
                number[a].alias("x"),
                number[b].alias("y"),
            )
            for a, b in product(columns, repeat=2)
        )
    )
    keep = ["Week"] if "Week" in df.columns else []
    return df.select(*keep, F.inline(pairs))
