"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallyline.plans.catalog import QUERIES
from tallyline.plans.oracle import SQL
from tests.oracle import check, connect

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert NAMES == sorted(SQL)


def test_contract_has_every_query():
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, con, name):
    assert check(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) > 0
