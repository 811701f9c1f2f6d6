"""Comparing a Spark result with DuckDB, rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, dt.datetime):
        return (1, value.isoformat())
    if isinstance(value, dt.date):
        return (1, dt.datetime(value.year, value.month, value.day).isoformat())
    if isinstance(value, bool):
        return (2, int(value))
    if isinstance(value, decimal.Decimal | float | int):
        return (2, value + 0)
    return (3, value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    at = [df.columns.index(n) for n in names]
    return names, sorted(tuple(_cell(row[i]) for i in at) for row in df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(tuple(_cell(row[i]) for i in at) for row in result.fetchall())
