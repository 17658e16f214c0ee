"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

from .parity import compare, database

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir_module):
    return database(sf_dir_module)


@pytest.fixture(scope="module")
def sf_dir_module():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, sf_dir_module, name):
    df = QUERIES[name](spark, sf_dir_module)
    if name in ORACLES:
        assert compare(df, ORACLES[name], connection) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["symbol", "count"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
