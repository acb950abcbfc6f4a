"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as contract
from checking import compare, connect
from paddockflow.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    good, message = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert good, message


def test_entry(spark):
    assert contract.entry(spark).count() > 0
