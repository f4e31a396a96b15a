"""Every named query against its SQL, with exact values and types."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from martloom.plans.catalog import QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_retail_query_has_sql():
    assert set(QUERIES) <= set(SQL)
