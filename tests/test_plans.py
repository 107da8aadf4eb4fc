
import re

import pytest

from ledgerline.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan as it was after the run, with what AQE changed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_cartesian_or_python(spark, name):
    text = plan(spark, name)
    assert not [k for k in FORBIDDEN if k in text]


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(spark, "latest_by")
    assert "WindowGroupLimit" in text


def test_interval_merge_aggregates_before_the_shuffle(spark):
    df = QUERIES["merge_intervals"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "Window" in text and "Generate inline" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "connection_info")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text
    text = plan(spark, "one_document")
    assert "EqualTo(doc_id,33)" in text


def test_no_scalar_subquery_and_no_horizon_in_coverage(spark):
    for name in ("paid_years", "paid_months", "paid_quarters"):
        assert "Subquery" not in plan(spark, name)


def test_stored_and_registered_results_are_not_sorted(spark):
    for name in ("duplicate_groups", "duplicate_rows", "white_label"):
        assert "rangepartitioning" not in executed(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["tiers", "client_report"])
def test_reports_read_the_client_base_from_one_stored_table(spark, name):
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert any("models/client_base-" in f for f in files)
    assert not any("lineitem" in f for f in files)


@pytest.mark.parametrize("name", ["anti_join", "not_in"])
def test_anti_joins_are_planned_as_anti(spark, name):
    text = plan(spark, name)
    assert "LeftAnti" in text
    # Spark marks a null-aware anti join (broadcast only) with a trailing ``true``.
    assert not re.search(r"LeftAnti, Build\w+, true", text)


def test_semi_join_is_planned_as_semi(spark):
    assert "LeftSemi" in plan(spark, "semi_join")


def test_missing_tickets_are_an_anti_join(spark):
    text = plan(spark, "subscriptions_missing_ticket")
    assert "LeftAnti" in text


def test_a_companys_subscriptions_are_filtered_at_the_scan(spark):
    assert "EqualTo(o_custkey,52)" in plan(spark, "subscriptions_of_company")


def test_equal_years_are_dropped_after_they_are_dealt_out(spark):
    """The task that reads a small file of companies holds none of their years."""
    text = plan(spark, "paid_quarters")
    assert re.search(r"HashAggregate\(keys=\[fy_id[^\n]*\n[^\n]*HashAggregate\(keys=\[fy_id[^\n]*\n[^\n]*Exchange hashpartitioning\(fy_id", text)


def test_cells_are_made_above_all_shuffles(spark):
    for name in ("paid_months", "paid_quarters"):
        text = plan(spark, name)
        assert 0 < text.index("Generate inline(transform(") < text.index("Exchange"), name


def test_packs_of_periods_are_shuffled_once(spark):
    for name in ("paid_months", "paid_quarters"):
        assert len(re.findall(r"Exchange hashpartitioning\([^\n]*__ll_s", plan(spark, name))) == 1, name


def test_interval_join_reads_the_items_once(spark):
    assert plan(spark, "interval_join").count("lineitem.parquet") == 1
