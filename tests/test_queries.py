"""Every registered query against its SQL on the driver tables."""

import pytest

import __spark_entry__ as registry
from compare import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    names, rows = spark_rows(registry.queries()[name](spark, SF))
    assert rows
    if name in SQL:
        sql_names, sql_rows = duck_rows(con, SQL[name])
        assert names == sql_names
        assert rows == sql_rows


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_every_line_has_its_order_part_customer_and_nation(con):
    """What the SQL's inner joins rely on."""
    found = con.execute(
        """SELECT count(*), count(o_orderkey), count(p_partkey), count(c_custkey),
        count(n_nationkey) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey"""
    ).fetchall()[0]
    assert len(set(found)) == 1
