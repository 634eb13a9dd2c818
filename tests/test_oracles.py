"""Every query against its SQL on the smallest test data."""

import pytest

import __spark_entry__ as contract
from verification.compare import connect, difference
from verification.oracles import ORACLES
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    assert difference(found, duck, ORACLES[name]) is None
