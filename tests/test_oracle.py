"""The driver's gate, run locally: every query against its DuckDB oracle at sf0.01, and
every derived view identical in both engines."""

import pytest

import __spark_entry__ as entry
from ledgerline.catalog import QUERIES
from ledgerline.sources.fixtures import VIEWS, Fixtures, duckdb_ctes
from ledgerline.sources.tables import Tables
from oracle_queries import oracle_sql
from tests.compare import compare, duck
from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_CHECK), con, oracle_sql()[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("view", sorted(VIEWS))
def test_views_identical_in_both_engines(spark, view):
    fx = Fixtures(Tables(spark, SF_SMALL))
    ok, msg = compare(fx[view], duck(SF_SMALL), duckdb_ctes([view]) + f"SELECT * FROM {view}")
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "is_month_paid" in df.columns
