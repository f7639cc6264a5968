"""Every query against its SQL on the smallest driver tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from suite.check import compare, connect
from suite.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    said = compare(spark, con, name, FOLDER)
    spark.catalog.clearCache()
    assert said.startswith("ok" if name in oracle_sql() else "rows only"), said


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
