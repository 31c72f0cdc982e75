"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import compare

import __spark_entry__ as contract
from ticklake.plans import catalog, oracle


def test_every_tick_query_has_a_twin():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", list(catalog.queries()))
def test_query_equals_sql(spark, key):
    assert compare(spark, SMALL, key) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 5
    assert rows[0].avg_return_pct >= rows[-1].avg_return_pct
