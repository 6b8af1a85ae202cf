"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest
from compare import check, database

import __spark_entry__ as entry_points
from facetmill import catalog

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = database(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    problem = check(spark, duck, FOLDER, name, catalog.QUERIES[name], catalog.SQL.get(name))
    assert problem is None, problem


def test_every_query_has_sql_and_is_registered():
    assert set(catalog.SQL) == set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(catalog.SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 27
