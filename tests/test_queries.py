"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import compare, duck, rows_of

import __spark_entry__ as entry_module
from weirflow.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_registry():
    assert set(ORACLES) == set(QUERIES) <= set(entry_module.queries())
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf, name):
    assert compare(spark, con, sf, name, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    names, rows = rows_of(entry_module.entry(spark).columns, entry_module.entry(spark).collect())
    assert names == ["event_type", "n", "topic", "total_k"] and rows
