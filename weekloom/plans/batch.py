"""The batch run: read the sources once, write every weekly table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from weekloom.operators.rollup import add_up, group_parts
from weekloom.plans.tables import GROUPS, OUTPUTS, TABLES, Rollup, Same, Tables, Top
from weekloom.sources.layer import Layer, Version
from weekloom.sources.tables import Source, fresh_folder, staged as kept, write_table

# Prepared sources that several tables share and that are costly to make.
STAGED = ("website_sales", "facebook_ads")

# Spark's setting for the bytes of one generated method, and the bytes from which on HotSpot only interprets it.
METHOD_LIMIT, HUGE = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Inside, a stage whose code would be one method too large to be compiled runs as many small ones.

    Joining and cleaning all columns of the orders at once makes such a method, and interpreting it takes more
    than twice as long as all the work.  Results don't depend on it; the session's setting comes back afterwards.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, min(int(before), HUGE))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def stage(spark: SparkSession, source: Source, names: Iterable[str]) -> dict[str, DataFrame]:
    """Write the shared prepared sources, with the columns ``names`` read, to a new folder.

    The tables then scan only their own columns of a columnar copy, so joins and text clean-up
    run once instead of once per table, and a lost executor costs no recomputation of them.
    """
    tables = Tables(source)
    staged = {}
    for prepared in STAGED:
        readers = [TABLES[n] for n in _with_inputs(names)]
        columns = dict.fromkeys(
            c for t in readers if getattr(t, "source", None) == prepared for c in t.columns()
        )
        if columns:
            folder = fresh_folder(spark, "stage")
            path = write_table(tables.prepared(prepared, list(columns)), folder, prepared)
            staged[prepared] = spark.read.parquet(path)
    return staged


def group(tables: Tables, names: Iterable[str], at_once: int = 4) -> dict[str, DataFrame]:
    """Write groups of the sources in GROUPS that more than one table of ``names`` can be added up from.

    Rows are then scanned once for all of these tables.  Sources with floating-point sums are left out, as
    partial sums of those are not exact.
    """
    found = _with_inputs(names)

    def write(prepared: str) -> DataFrame | None:
        readers = [
            t for n, t in TABLES.items()
            if n in found and isinstance(t, Rollup) and t.source == prepared and t.in_groups
        ]
        if len(readers) < 2:
            return None
        measures = list(dict.fromkeys(m for t in readers for m in t.measures.values()))
        keys = [k for k in GROUPS[prepared] if any(k in t.keys for t in readers)]
        rows = tables.prepared(prepared, [*keys, *(m.column for m in measures)])
        return kept(group_parts(rows, keys, measures), "groups") if add_up(rows, measures) else None

    with ThreadPoolExecutor(at_once) as pool:
        made = dict(zip(GROUPS, pool.map(write, GROUPS), strict=True))
    return {prepared: groups for prepared, groups in made.items() if groups is not None}


def run_batch(
    spark: SparkSession,
    source: Source,
    target: str,
    names: Iterable[str] = OUTPUTS,
    at_once: int = 4,
) -> Layer:
    """Write the tables ``names`` to the layer under ``target`` and publish them together.

    Until all are written, readers of the layer see the tables of the run before, and keep seeing them
    if this one fails.  Rankings and copies start from the written table they belong to.  Tables of one wave do
    not depend on each other; ``at_once`` of them run together to keep all executors busy.
    """
    names = list(names)
    layer = Layer(spark, target)
    later = [n for n in names if isinstance(TABLES[n], Top | Same) and TABLES[n].of in names]
    made: dict[str, Version] = {}
    with compiled(spark):
        staged = stage(spark, source, names)
        groups = group(Tables(source, staged), names, at_once)
        for wave in ([n for n in names if n not in later], later):
            tables = Tables(source, staged, {n: layer.read(v) for n, v in made.items()}, groups)
            with ThreadPoolExecutor(at_once) as pool:
                made |= zip(wave, pool.map(lambda n: layer.write(n, tables[n]), wave), strict=True)
    layer.publish(made.values())
    return layer


def _with_inputs(names: Iterable[str]) -> set[str]:
    """The tables ``names`` and all tables they are made from."""
    found: set[str] = set()
    open_names = list(names)
    while open_names:
        name = open_names.pop()
        if name not in found:
            found.add(name)
            if isinstance(TABLES[name], Top | Same):
                open_names.append(TABLES[name].of)
    return found
