"""Every registered query against DuckDB, on whole test tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from parity import connect, differences

import __spark_entry__ as contract
from tripmill.registry.oracles import ORACLES as SQL
from tripmill.registry.queries import REGISTRY

QUERIES, ORACLES = REGISTRY, SQL


def test_the_contract_holds_every_query():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    result = contract.entry(spark)
    assert "tip_pct" in result.columns
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == ""
