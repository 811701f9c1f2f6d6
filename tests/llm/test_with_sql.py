"""Queries that SQL can express, row by row."""

import pytest

from weekloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_gives_the_rows_of_its_sql(spark, oracle, name):
    folder, con = oracle
    found = queries.QUERIES[name](spark, folder)
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(found.columns)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(rows, key=key) == sorted(map(tuple, result.fetchall()), key=key)
