"""The stored weekly layer: published versions of weekly tables, pruned by week.

A table is written beside its older versions, and becomes current with one row in the layer's manifest, an
append of one file.  Readers see the old version or the new one, a job that fails leaves the old one,
and a whole batch is published at once.  The manifest also keeps each version's first and last week, so
a range of the last days knows its dates before anything is read.

Tables are partitioned by the year of their week and sorted by week inside.  A range of weeks is
a partition filter on the year, which skips folders, and a pushed filter on the week, which skips row groups.
A folder for each week would hold a file of a few rows for most tables.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.dates import read_week
from weekloom.operators.rollup import quoted
from weekloom.sources.tables import Source, pick

YEAR = "Week_Year"
#: Rows of the manifest.
MANIFEST = """number bigint, name string, path string, schema string, row_count bigint,
    first_week date, last_week date, stamp string"""


class Version(NamedTuple):
    """A written table: where it lies, what it holds, and the stamp of what it was made from."""

    number: int
    name: str
    path: str
    schema: str
    row_count: int
    first_week: dt.date | None
    last_week: dt.date | None
    stamp: str | None = None


class Layer:
    """Published tables under a folder that the session's executors share."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self._current: dict[str, Version] | None = None

    def versions(self) -> DataFrame:
        """The manifest, a row for each version ever published."""
        reader = self.spark.read.schema(MANIFEST)
        try:
            return reader.parquet(f"{self.base}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self) -> dict[str, Version]:
        """The newest version of each table, as of the first call or of :meth:`refresh`."""
        if self._current is None:
            newest = self.versions().groupBy("name").agg(
                F.max_by(F.struct("*"), F.struct("number", "path")).alias("version")
            )
            rows = newest.select("version.*").collect()  # a row for each table
            self._current = {row["name"]: Version(*row) for row in rows}
        return self._current

    def refresh(self) -> None:
        self._current = None

    def write(self, name: str, df: DataFrame, stamp: str | None = None) -> Version:
        """Write a version of a table; readers don't see it until it is published."""
        path = f"{self.base}/{name}/{uuid.uuid4().hex}"
        week = _week(df)
        if week is None:
            df.write.parquet(path)
        else:
            # adaptive execution unites small years and splits large ones
            dealt = df.withColumn(YEAR, F.year(week)).hint("rebalance", YEAR)
            dealt.sortWithinPartitions(YEAR, "Week").write.partitionBy(YEAR).parquet(path)
        made = Version(0, name, path, df.schema.json(), 0, None, None, stamp)
        written = self.read(made)
        week = _week(written)
        none = F.lit(None).cast("date")
        count, first, last = written.agg(
            F.count(F.lit(1)),
            F.min(week).cast("date") if week is not None else none,
            F.max(week).cast("date") if week is not None else none,
        ).first()
        return made._replace(row_count=count, first_week=first, last_week=last)

    def read(self, version: Version) -> DataFrame:
        """The rows of a version, published or not."""
        schema = T.StructType.fromJson(json.loads(version.schema))
        return self._partitioned(version).select(*map(quoted, schema.names))

    def _partitioned(self, version: Version) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(version.schema))
        if "Week" in schema.names:
            schema = schema.add(YEAR, T.IntegerType())
        return self.spark.read.schema(schema).parquet(version.path)

    def publish(self, made: Iterable[Version]) -> None:
        """Make versions current, all of them at once."""
        number = 1 + (self.versions().agg(F.max("number")).first()[0] or 0)
        rows = [version._replace(number=number) for version in made]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.base}/manifest"
        )
        self.refresh()

    def replace(self, name: str, df: DataFrame, stamp: str | None = None) -> DataFrame:
        """Write and publish one table."""
        self.publish([self.write(name, df, stamp)])
        return self[name]

    def __contains__(self, name: str) -> bool:
        return name in self.current()

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(self._version(name))

    def between(self, name: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
        """Rows of the weeks from ``first`` to ``last``, with weeks as timestamps where they are labels.

        A table without weeks comes whole; a missing bound leaves no rows.
        """
        rows = self._partitioned(self._version(name))
        week = _week(rows)
        if week is None:
            return rows
        bounds = [F.lit(day).cast("date") for day in (first, last)]
        years = [F.lit(day.year if day else None).cast("int") for day in (first, last)]
        if isinstance(rows.schema["Week"].dataType, T.StringType):
            rows = rows.withColumn("Week", week)
        kept = rows.where(F.col(YEAR).between(*years) & F.col("Week").between(*bounds))
        return kept.drop(YEAR)

    def last_days(self, name: str, days: int | None, anchor: str) -> DataFrame:
        """Rows in the last ``days`` before the last week of ``anchor``; None: in all of its weeks."""
        return self.between(name, *self.days(anchor, days))

    def days(self, anchor: str, days: int | None) -> tuple[dt.date | None, dt.date | None]:
        """The first and last day of :meth:`last_days`, from the manifest alone."""
        of = self._version(anchor)
        if days is None or of.last_week is None:
            return of.first_week, of.last_week
        return of.last_week - dt.timedelta(days), of.last_week

    def _version(self, name: str) -> Version:
        found = self.current().get(name)
        if found is None:
            raise KeyError(f"{name!r} is not published in {self.base}")
        return found

    def outdated(self, keep: int = 1) -> list[str]:
        """Folders of versions older than the newest ``keep`` of their table, which may be deleted.

        Only once no running query reads them, so the layer doesn't do it by itself.
        """
        old: dict[str, list] = {}
        for row in self.versions().select("name", "number", "path").collect():
            old.setdefault(row["name"], []).append((row["number"], row["path"]))
        return [path for rows in old.values() for _, path in sorted(rows, reverse=True)[keep:]]


def layer_source(layer: Layer) -> Source:
    """The tables of a layer as a source."""
    return lambda name, columns=None: pick(name, layer[name], columns)


class StoredRange:
    """Weekly tables by name, cut to a range of weeks when they are read."""

    def __init__(self, tables: StoredTables, first: dt.date | None, last: dt.date | None) -> None:
        self._tables, self._first, self._last = tables, first, last

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables.layer.between(self._tables.fresh(name), self._first, self._last)


class StoredTables:
    """Weekly tables by name from a layer; one not stored yet, or made from other data, is made first.

    ``make`` computes a table by name.  ``stamp`` tells the state of the data; a stored table with
    another stamp is replaced.  Making a table is a job that runs when the table is asked for.
    """

    def __init__(self, layer: Layer, make, stamp: str, names: dict[str, str] | None = None) -> None:
        self.layer, self._make, self._stamp, self._names = layer, make, stamp, dict(names or {})

    def fresh(self, name: str) -> str:
        name = self._names.get(name, name)
        found = self.layer.current().get(name)
        if found is None or found.stamp != self._stamp:
            self.layer.replace(name, self._make(name), self._stamp)
        return name

    def __getitem__(self, name: str) -> DataFrame:
        return self.layer[self.fresh(name)]

    def between(self, first: dt.date | str, last: dt.date | str) -> StoredRange:
        days = (dt.date.fromisoformat(str(day)) for day in (first, last))
        return StoredRange(self, *days)

    def last_days(self, days: int | None, anchor: str) -> StoredRange:
        return StoredRange(self, *self.layer.days(self.fresh(anchor), days))


def stamp_of(spark: SparkSession, paths: Sequence[str]) -> str:
    """The state of files: a hash of all their names, sizes and times, read without their content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
    )
    return "-".join(map(str, files.agg(F.count("h"), F.sum("h")).first()))


def _week(df: DataFrame):
    """The column of the week as a moment; None for a table without one."""
    if "Week" not in df.columns:
        return None
    labelled = isinstance(df.schema["Week"].dataType, T.StringType)
    return read_week("Week") if labelled else F.col("Week")
