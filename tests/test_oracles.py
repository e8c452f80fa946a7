"""Every registered query with an SQL twin gives the twin's rows, names, types and values."""

import pytest

import __spark_entry__ as entry
from check import compare, oracle_connection
from conftest import SF


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
