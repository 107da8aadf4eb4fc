"""Reports can be had in the reference's presentation order (O1, O3); stored ones are not
sorted."""

from ledgerline.catalog import INVOICE_AS_OF, _fx
from ledgerline.plans import client_base, invoices
from tests.conftest import SF_CHECK


def test_duplicate_report_most_copies_first(spark):
    out = invoices.duplicate_line_invoices(_fx(spark, SF_CHECK)["documents_json"], INVOICE_AS_OF, ordered=True)
    counts = [r.number_of_dublicates for r in out.collect()]
    assert counts == sorted(counts, reverse=True) and counts


def test_snapshot_audit_by_scd_id(spark):
    out = invoices.repeated_snapshot_keys(_fx(spark, SF_CHECK)["journal_snapshot"], ordered=True)
    ids = [r.dbt_scd_id for r in out.collect()]
    assert ids == sorted(ids) and ids


def test_white_label_by_partner_nulls_last(spark):
    fx = _fx(spark, SF_CHECK)
    out = client_base.white_label_report(
        fx["white_label"], fx["dim_companies"], fx["dim_contracts"], fx["dim_contract_items"],
        fx["fact_products"], ordered=True,
    )
    partners = [r.partner for r in out.collect()]
    present = [p for p in partners if p is not None]
    assert present == sorted(present)
    assert partners[: len(present)] == present
