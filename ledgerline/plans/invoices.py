"""Duplicate invoices read from JSON document details (K7, K8) and the snapshot-key
audit (K11)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.json import exact_array, exact_value, with_exact_json
from ledgerline.operators.quality import duplicate_groups, duplicate_rate, duplicate_rows

# The JSON paths of the invoice fields and the filters of the audits.
INVOICE_FIELDS = {
    "invoice_number": "$.invoiceNumber",
    "issue_date": "$.issueDate",
    "currency": "$.currency",
    "subTotal": "$.subTotal",
    "total": "$.amount",
}
SOURCE_PATH = "$.externalDetails.source"
LINE_ITEMS_PATH = "$.lineItems"
SOURCE = "bluesheets"
LINE_SUBCATEGORIES = ["invoice", "invoiceOut", "receipt"]
RATE_SUBCATEGORIES = ["invoice", "invoiceIn", "invoiceOut", "receipt"]
LINE_SINCE = dt.date(2021, 1, 1)
RATE_SINCE = dt.date(2022, 1, 1)
KEY = ["companyid", *INVOICE_FIELDS]


def invoice_fields(
    documents: DataFrame,
    since: dt.date,
    as_of: dt.date,
    subcategories: Sequence[str],
    source: str = SOURCE,
) -> DataFrame:
    """Invoice fields of documents created in ``[since, as_of]`` from ``source``, with a
    non-empty invoice number: ``companyid, <fields>, subcategory, __ll_json`` (the parsed
    details, for further fields).  Each document's JSON is parsed once.  Numbers are the
    document's own text: ``1.50`` and ``1.5`` are different totals."""
    day = F.to_date("createdat")
    docs = documents.filter(
        day.between(F.lit(since), F.lit(as_of)) & F.col("subcategory").isin(list(subcategories))
    ).select("companyid", "subcategory", "details")
    parsed = with_exact_json(docs, "details", "__ll_json")
    fields = [exact_value("__ll_json", path).alias(name) for name, path in INVOICE_FIELDS.items()]
    return (
        parsed.select(
            "companyid", *fields, "subcategory", "__ll_json",
            exact_value("__ll_json", SOURCE_PATH).alias("__ll_source"),
        )
        .filter(
            F.col("invoice_number").isNotNull()
            & (F.col("invoice_number") != "")
            & (F.col("__ll_source") == source)
        )
        .drop("__ll_source")
    )


def duplicate_line_invoices(
    documents: DataFrame, as_of: dt.date, ordered: bool = False
) -> DataFrame:
    """Invoice keys seen more than once after unnesting the line items (K7); with
    ``ordered`` most copies first, the report's order, which is for showing: nearly all
    groups have the same count, and a stored result is not sorted.

    As in the reference, an invoice counts once per line item, so one invoice with two
    line items is its own duplicate, and one without line items is not counted."""
    base = invoice_fields(documents, LINE_SINCE, as_of, LINE_SUBCATEGORIES)
    lines = base.select(*KEY, F.explode(exact_array("__ll_json", LINE_ITEMS_PATH)).alias("__ll_li"))
    groups = duplicate_groups(lines.drop("__ll_li"), KEY, "number_of_dublicates")
    return groups.orderBy(F.col("number_of_dublicates").desc(), *KEY) if ordered else groups


def duplicate_invoice_rate(documents: DataFrame, as_of: dt.date) -> DataFrame:
    """Mean surplus copies per duplicated invoice, by subcategory (K8).  Totals of
    ``"0"`` (and unknown totals) are left out."""
    base = invoice_fields(documents, RATE_SINCE, as_of, RATE_SUBCATEGORIES).filter(
        ~F.col("total").isin("0")
    )
    groups = duplicate_groups(base.drop("__ll_json"), [*KEY, "subcategory"], "number_of_dublicates")
    return duplicate_rate(groups, ["subcategory"], "number_of_dublicates", "avg_excess_copies")


def repeated_snapshot_keys(
    snapshot: DataFrame, key: str = "dbt_scd_id", ordered: bool = False
) -> DataFrame:
    """Snapshot rows whose scd id is not unique (K11); by scd id and the other columns, so
    that a hot id can be split, when ``ordered`` for showing."""
    rows = duplicate_rows(snapshot, key)
    return rows.orderBy(key, *[c for c in snapshot.columns if c != key]) if ordered else rows
