"""Every query with a SQL statement gives the same rows and types as DuckDB; the rest give rows."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, duck
from tidemark.catalog import QUERIES, SQL

SLOW = {"model_registry"}  # covered by test_models


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, con, name):
    ok, note = compare(QUERIES[name](spark, folder), con, SQL[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    # keys, date, target, split and 53 features
    assert len(df.columns) == 4 + 53


def test_registry_is_consistent():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 100
