"""Optional filters of the models (the reference's point lookups and commented filters)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.catalog import LINK_PREFIX, _fx
from ledgerline.plans import client_base, subscriptions
from tests.conftest import SF_CHECK


def _match(spark, **kw):
    fx = _fx(spark, SF_CHECK)
    return subscriptions.subscription_ticket_match(
        fx["financial_years"], fx["contracts"], fx["contract_items"], fx["products"],
        fx["subscriptions"], fx["tickets"], fx["companies"], LINK_PREFIX, **kw,
    )


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def test_subscription_filters_are_restrictions_of_the_full_match(spark):
    full = _match(spark)
    company = full.select("company_id").first().company_id
    assert _rows(_match(spark, company_id=company)) == _rows(full.filter(F.col("company_id") == company))
    assert _rows(_match(spark, missing_only=True)) == _rows(full.filter(F.col("ticket_id").isNull()))
    assert _rows(_match(spark, end_mismatch_only=True)) == _rows(full.filter(~F.col("is_end_matched")))
    day = dt.date(2000, 1, 1)
    assert _rows(_match(spark, ended_before=day)) == _rows(full.filter(F.col("subscription_end") < day))


def test_point_lookups(spark):
    fx = _fx(spark, SF_CHECK)
    docs = client_base.document_recipients(fx["dim_documents"], fx["dim_companies"])
    key = docs.select("document_key").first().document_key
    one = client_base.document_recipients(fx["dim_documents"], fx["dim_companies"], document_key=key)
    assert [r.document_key for r in one.collect()] == [key]
    comps = client_base.company_lookup(fx["dim_companies"])
    ck = comps.select("company_key").first().company_key
    assert [r.company_key for r in client_base.company_lookup(fx["dim_companies"], ck).collect()] == [ck]
