"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as contract
from workload.registry import QUERIES
from tests.compare import difference, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0
