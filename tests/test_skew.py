"""Results stay whole and exact when one key holds a third of all rows.

The skewed inputs reassign a third of the contracts and of the tickets to company 0, a
third of the invoice documents to company 0, and a third of the snapshot rows to one scd
id.  The same overridden view texts feed Spark and the DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from ledgerline.sources.fixtures import VIEWS
from oracle_queries import oracle_sql
from tests.compare import compare, duck
from tests.conftest import SF_CHECK


def _swap(view: str, old: str, new: str) -> str:
    text = VIEWS[view]
    assert old in text, (view, old)
    return text.replace(old, new)


HOT = {
    "contracts": _swap(
        "contracts", "o_custkey AS company_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS company_id",
    ),
    "dim_contracts": _swap(
        "dim_contracts", "o_custkey AS company_key",
        "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS company_key",
    ),
    "tickets": _swap(
        "tickets", "(user_id * 10 + event_id % 10) AS company_id",
        "CASE WHEN event_id % 3 = 0 THEN 0 ELSE (user_id * 10 + event_id % 10) END AS company_id",
    ),
    "documents_json": _swap(
        "documents_json", "user_id AS companyid",
        "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS companyid",
    ),
    "journal_snapshot": _swap(
        "journal_snapshot",
        "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS dbt_scd_id",
        "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE CAST(l_orderkey AS STRING) || '-' || "
        "CAST(l_linenumber AS STRING) END AS dbt_scd_id",
    ),
}

QUERIES = [
    "items_by_service", "merge_intervals", "running_sum", "paid_years", "paid_months",
    "paid_quarters", "accounting_items", "last_active", "last_inactive", "unresolved_ticket",
    "client_status", "subscription_ticket_match", "interval_join", "duplicate_groups",
    "duplicate_rate", "duplicate_rows", "window_count", "client_base", "tiers",
    "client_report", "white_label", "not_in", "having", "bool_or", "count_distinct",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.fixture(scope="module")
def sql():
    return oracle_sql(HOT)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_key_results_match_oracle(spark, con, sql, name):
    df = entry.queries()[name](spark, SF_CHECK, HOT)
    ok, msg = compare(df, con, sql[name])
    assert ok, msg


def test_hot_key_really_is_hot(spark):
    from ledgerline.sources.fixtures import Fixtures
    from ledgerline.sources.tables import Tables

    fx = Fixtures(Tables(spark, SF_CHECK), HOT)
    contracts = fx["contracts"]
    share = contracts.filter("company_id = 0").count() / contracts.count()
    assert 0.3 < share < 0.37
