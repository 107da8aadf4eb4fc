"""The stored model chain gives the same rows as the direct queries."""

import tempfile

import __spark_entry__ as entry
from ledgerline.catalog import LINK_PREFIX, REPORT_AS_OF
from ledgerline.plans.chain import run_paid_chain, run_report_chain
from ledgerline.session import checkpoint_dir
from ledgerline.sources.fixtures import Fixtures
from ledgerline.sources.tables import Tables, materialize
from tests.conftest import SF_SMALL


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def test_chain_matches_direct_queries(spark):
    fx = Fixtures(Tables(spark, SF_SMALL))
    out = tempfile.mkdtemp(prefix="ledgerline-chain-")
    paths = run_paid_chain(
        fx["contracts"], fx["contract_items"], fx["sku_for_tickets"], fx["financial_years"], out
    )
    pairs = {
        "paid_periods": "merge_intervals",
        "rejected_intervals": "rejected_intervals",
        "paid_financial_years": "paid_years",
        "paid_months": "paid_months",
        "paid_quarters": "paid_quarters",
    }
    for stored, query in pairs.items():
        got = spark.read.parquet(paths[stored])
        want = entry.queries()[query](spark, SF_SMALL)
        assert _rows(got) == _rows(want), stored


def test_materialize_uses_the_session_checkpoint_dir(spark):
    df = spark.range(5)
    back = materialize(df, "five")
    assert back.count() == 5
    def path(uri):
        return uri.split(":", 1)[-1].lstrip("/")

    assert path(back.inputFiles()[0]).startswith(path(checkpoint_dir(spark)))


def test_report_chain_matches_direct_queries(spark):
    fx = Fixtures(Tables(spark, SF_SMALL))
    out = tempfile.mkdtemp(prefix="ledgerline-reports-")
    paths = run_report_chain(
        fx["dim_contracts"], fx["dim_contract_items"], fx["fact_products"], fx["dim_companies"],
        fx["dim_subscriptions"], fx["white_label"], fx["connections"], fx["transactions"],
        fx["fact_financial_years"], fx["positions"], fx["dim_companies_lambda"], REPORT_AS_OF,
        LINK_PREFIX, out,
    )
    for name in ("client_base", "tiers", "client_report", "last_payroll_service", "last_acc_service"):
        got = spark.read.parquet(paths[name])
        want = entry.queries()[name](spark, SF_SMALL)
        assert _rows(got) == _rows(want), name


def test_model_builder_writes_requested_tables(spark):
    from ledgerline.__main__ import main

    out = tempfile.mkdtemp(prefix="ledgerline-cli-")
    done = main(["--data", SF_SMALL, "--out", out, "--only", "surrogate_key,tag_status"], spark=spark)
    assert set(done) == {"surrogate_key", "tag_status"}
    for name in done:
        got = spark.read.parquet(done[name])
        assert _rows(got) == _rows(entry.queries()[name](spark, SF_SMALL))


def test_save_replaces_a_table_only_by_a_whole_one(spark):
    import pytest
    from pyspark.sql import functions as F

    from ledgerline.sources.tables import save

    path = tempfile.mkdtemp(prefix="ledgerline-save-") + "/t"
    save(spark.range(10).withColumn("svc", F.lit("7")), path, ["svc"])
    bad = spark.range(5).withColumn("svc", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        save(bad, path)
    kept = save(spark.read.schema("id long, svc string").parquet(path), path + "2", ["svc"])
    assert kept.count() == 10 and dict(kept.dtypes)["svc"] == "string"
