"""Every registered query gives the rows of its SQL oracle, and is described by one."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import differences, oracle_connection
from oracles.registry import oracle_queries
from tradewind.plans.registry import registered_queries

# The text queries have their own tests, and go with their package.
QUERIES = registered_queries()
ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def connection(sample):
    return oracle_connection(sample)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_contract_holds_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark, sample, connection):
    frame = QUERIES[name](spark, sample)
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    rows = [tuple(r) for r in frame.collect()]
    assert differences(frame.columns, rows, columns, result.fetchall()) is None
