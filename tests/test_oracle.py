"""Every query against its SQL on the smallest scale."""

import pytest

from checks.catalog import QUERIES
from checks.compare import difference, oracle_connection
from checks.oracle import statements

SF = "/root/testdata/sf0.001"
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None
