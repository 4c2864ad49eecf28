"""Every registered query equals its SQL counterpart: names, types and all values exactly."""

import os

import pytest

import __spark_entry__ as contract
from contract.oracles import ORACLES
from contract.registry import REGISTRY
from tests.compare import open_tables, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, db, name):
    got_types, got = spark_rows(REGISTRY[name](spark, SF_DIR))
    want_types, want = sql_rows(db, ORACLES[name])
    assert got_types == want_types
    # NaN is unequal to itself; its text is compared instead.
    assert list(map(repr, got)) == list(map(repr, want))
    assert got, "a query without rows checks nothing"


def test_entry(spark):
    assert contract.entry(spark).count() == 100
