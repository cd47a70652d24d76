"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from checks import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare.differences(spark, db, SF, name) == []


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns[-1] == "sq_hash"
