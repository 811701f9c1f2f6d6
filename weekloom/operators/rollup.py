"""Grouped measures with the NULL rules of the weekly tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from weekloom.functions.measures import Difference, Measure, Ratio, aggregate, with_derived
from weekloom.operators import exact as exactly


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is NULL."""
    if not columns:
        return df
    return df.where(" AND ".join(f"`{column}` IS NOT NULL" for column in columns))


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    derived: Mapping[str, Ratio | Difference] | None = None,
    nullable: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Aggregate ``df`` by ``keys`` and add ratios.

    Rows with a NULL key are left out, except for the keys named in ``nullable``.  Every
    measure combines before the shuffle, so a key holding much of the data moves one partial
    row per task; distinct counts shuffle on (keys, value) first for the same reason.

    With ``exact``, sums and means of floating-point columns are the nearest doubles to the true
    ones and don't depend on the order of rows (:mod:`weekloom.operators.exact`).
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    kept = require(df, [key for key in keys if key not in nullable])
    summed = [m for m in measures.values() if m.how in ("sum", "mean")]
    if exact and any(exactly.is_double(types[m.column]) for m in summed):
        flags = {m.column for m in summed if isinstance(types[m.column], T.BooleanType)}
        kept = kept.withColumns({c: quoted(c).cast("int") for c in flags})
        out = exactly.grouped(kept, keys, measures)
        out = out.select(
            *keys,
            *(_filled(m, types[m.column], name).alias(name) for name, m in measures.items()),
        )
    else:
        columns = [aggregate(m, types[m.column]).alias(name) for name, m in measures.items()]
        grouped = kept.groupBy(*keys) if keys else kept
        out = grouped.agg(*columns)
    return with_derived(out, derived or {})


def _filled(measure: Measure, dtype: T.DataType, name: str) -> Column:
    """A finished measure with the types and zeros of :func:`aggregate`."""
    if measure.how != "sum":
        return quoted(name)
    whole = isinstance(dtype, T.IntegralType | T.BooleanType)
    return F.coalesce(quoted(name), F.lit(0)).cast("bigint" if whole else "double")


def rollup_late(
    df: DataFrame,
    keys: Sequence[str],
    late: Mapping[str, tuple[str, Callable[[str], Column]]],
    measures: Mapping[str, Measure],
    derived: Mapping[str, Ratio | Difference] | None = None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """As :func:`rollup`, for keys that are costly to compute from a column of few values.

    ``late`` gives for such a key the column of ``df`` it is made from and how.  Rows are grouped by that column
    first, the key is made once for each group, and the groups are summed up again.  Measures are sums and
    counts of columns that are not floating-point, so that partial sums lose nothing.
    """
    if not add_up(df, measures.values()):
        raise ValueError("distinct counts, means and floating-point sums do not add up from partial results")
    ready = [key for key in keys if key not in late]
    early = [late[key][0] if key in late else key for key in keys]
    once = group_parts(require(df, [key for key in ready if key not in nullable]), early, measures.values())
    made = [late[key][1](late[key][0]).alias(key) if key in late else quoted(key) for key in keys]
    groups = once.select(*made, *(quoted(part) for part in once.columns[len(early):]))
    return rollup_parts(groups, keys, measures, derived, nullable)


def add_up(df: DataFrame, measures: Iterable[Measure]) -> bool:
    """Whether all measures of ``df`` come out the same from partial sums and counts."""
    return all(
        m.how == "count" or (m.how == "sum" and not exactly.is_double(df.schema[m.column].dataType))
        for m in measures
    )


def group_parts(df: DataFrame, keys: Sequence[str], measures: Iterable[Measure]) -> DataFrame:
    """Groups of ``df``, those with NULL keys too, with the partial result of each measure."""
    parts = {}
    for m in measures:
        whole = isinstance(df.schema[m.column].dataType, T.BooleanType) and m.how == "sum"
        column = quoted(m.column).cast("int") if whole else quoted(m.column)
        parts[_part(m)] = (F.sum if m.how == "sum" else F.count)(column)
    return df.groupBy(*keys).agg(*(column.alias(name) for name, column in parts.items()))


def rollup_parts(
    groups: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    derived: Mapping[str, Ratio | Difference] | None = None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """As :func:`rollup` over rows that :func:`group_parts` has grouped by ``keys`` and maybe others."""
    kept = require(groups, [key for key in keys if key not in nullable])
    added = kept.groupBy(*keys).agg(*(F.sum(quoted(_part(m))).alias(name) for name, m in measures.items()))
    out = added.select(
        *keys,
        *(
            (F.coalesce(quoted(name), F.lit(0)).cast("bigint") if m.how == "count"
             else _filled(m, groups.schema[_part(m)].dataType, name)).alias(name)
            for name, m in measures.items()
        ),
    )
    return with_derived(out, derived or {})


def _part(measure: Measure) -> str:
    return f"_{measure.how}_{measure.column}"
