"""Where source tables come from and where weekly tables go."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from weekloom.sources.schemas import check_columns

# (table, columns or None for all of them) -> DataFrame
Source = Callable[[str, "Sequence[str] | None"], DataFrame]

#: Splits from which on an input is never dealt out anew.
FEW_SPLITS = 16


def pick(table: str, df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The given columns of a table, all of them for None."""
    if columns is None:
        return df
    check_columns(table, df, list(columns))
    return df.select(*columns)


def parquet_source(spark: SparkSession, base: str) -> Source:
    """Tables as parquet folders ``<base>/<table>``."""
    return lambda table, columns=None: pick(
        table, spark.read.parquet(f"{base.rstrip('/')}/{table}"), columns
    )


def catalog_source(spark: SparkSession, database: str | None = None) -> Source:
    """Tables of the session catalog."""
    prefix = f"{database}." if database else ""
    return lambda table, columns=None: pick(table, spark.table(prefix + table), columns)


def jdbc_source(
    spark: SparkSession,
    url: str,
    split_by: dict[str, tuple[str, str, str, int]] | None = None,
    **options: str,
) -> Source:
    """Tables of a relational database.

    ``split_by`` gives per table (column, lower bound, upper bound, reads in parallel); without
    it the database driver would send the whole table through a single task.
    """

    def read(table: str, columns: Sequence[str] | None = None) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        if split_by and table in split_by:
            column, lower, upper, parts = split_by[table]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        return pick(table, reader.load(), columns)

    return read


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share an input of very few splits among all cores, by the hash of ``keys``.

    An input of FEW_SPLITS or more keeps its splits, however many cores there are, so what is
    shuffled here never exceeds that many.  Hashing sends a row to the same place when a task runs
    again and, unlike dealing rows out in turn, needs no sort for that.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < min(cores, FEW_SPLITS)
    return df.repartition(cores, *keys) if few else df


def write_table(df: DataFrame, base: str, name: str) -> str:
    """Replace the parquet table ``<base>/<name>`` and return its path."""
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def save_table(df: DataFrame, name: str, database: str | None = None) -> None:
    """Replace a table of the session catalog."""
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}" if database else name)


def write_jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Replace a database table."""
    writer = df.write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=name, **options).save()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, taken from ``spark.checkpoint.dir``.

    A session that names none keeps staged data in its warehouse, which its executors share too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A name for a new folder under :func:`shared_folder`."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{os.urandom(6).hex()}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it from there, so it is computed once."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
