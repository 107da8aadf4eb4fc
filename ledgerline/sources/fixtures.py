"""Input views of the billing warehouse, derived from the driver's TPC-H-like tables.

The reference reads some twenty warehouse tables (contracts, contract items, tickets,
financial years, white-label dashboard, connections, ...).  The test data holds none of
them, so each one is *derived* here from the driver's tables with one SQL text.  The same
text is run by Spark (``spark.sql(text, **frames)``) and, inside the oracle SQL, by DuckDB,
so both engines start from identical inputs and every view grows with the base tables.

Text conventions: ``{name}`` is a base table or another view; ``{{`` and ``}}`` are literal
braces (JSON); ``<<name>>`` is one of the few engine-specific snippets in ``SNIPPETS``.
Rows are never sampled or capped: each view covers its whole base table, and the number
of its keys grows with the data.  Odd inputs that the models must handle are part of the
views: missing, reversed and very early starts, repeated and far-off financial years,
malformed JSON and objects that repeat a member.

Company keys: customers are ``0..N-1``; event users are ``0..N/10-1``, so an event belongs
to company ``user_id * 10 + event_id % 10`` and every company gets its share of events.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ledgerline.sources.tables import Tables

# --- fixed values shared with the reference's queries ---------------------------------
# SKU codes that the reference's queries test by name (tier lists, Xero products, the
# subscription exclusions).  Part keys 1..26 carry them, in this order; every other part
# gets a code of its own, so item codes stay unique per product.
NAMED_SKUS = [
    "0008-AT-Xero",
    "SG-DIGITAL-XERO",
    "0008-AT-FS",
    "0008-AT-FS+Tax",
    "08-AT-R+T",
    "SG-AC-UFS-TAX",
    "08-AT-R",
    "SG-AC-UNI",
    "SG-AC-UNI-G",
    "SG-AC-EC-UNICORN-M",
    "SG-AC-ROCK",
    "SG-AC-ROCK-G",
    "SG-AC-EC-ROCK-M",
    "SG-AC-UNIC-REV-HW",
    "SG-AC-OTHR",
    "0009-PH-Y",
    "SG-AC-UNIC-REV",
    "SG-AC-EC-UNICORN-Y",
    "SG-AC-UNI-G-AB",
    "SG-AC-UNI-AB",
    "SG-AC-ROCK-REV",
    "SG-AC-EC-ROCK-Y",
    "SG-AC-ROCK-G-AB",
    "SG-AC-ROCK-AB",
    "0008-AT-FCC month",
    "0008-AT-FCC year",
]


def _sku_code(key_sql: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(NAMED_SKUS, start=1))
    return f"CASE {key_sql} {whens} ELSE 'SKU-' || CAST({key_sql} AS STRING) END"


_ITEM_KEY = (
    "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
    "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
)
_EVENT_COMPANY = "(user_id * 10 + event_id % 10)"
# Comma-separated company tags (a quarter of the companies have none).
_TAGS = (
    "CASE c_custkey % 4 WHEN 0 THEN NULL ELSE "
    "CASE WHEN c_custkey % 3 = 0 THEN 'ecommerce,' ELSE '' END || "
    "CASE c_custkey % 5 WHEN 0 THEN 'mia' WHEN 1 THEN 'paidStrikeOff' WHEN 2 THEN 'ndStrikeOff' "
    "ELSE 'none' END END"
)

# Engine-specific snippets: a six-row generator per customer (financial years 1..6).
SNIPPETS = {
    "spark": {"six": "explode(sequence(1, 6))"},
    "duckdb": {"six": "unnest(generate_series(1, 6))"},
}

VIEWS: dict[str, str] = {
    # ---------------- billing core (S1-S10) ----------------
    "companies": """
SELECT c_custkey AS company_id, c_name AS name,
  CASE WHEN c_nationkey % 5 < 3 THEN 'SG' ELSE 'HK' END AS branch,
  c_custkey % 50 = 0 AS is_test_company,
  CASE WHEN c_acctbal > 0 THEN DATE '1995-01-01' END AS first_invoice_paid_at,
  c_mktsegment <> 'FURNITURE' AS has_accounting_contract,
  make_date(1990 + CAST(c_custkey % 10 AS INT), 1, 1) AS incorporation_date
FROM {customer}""",
    "contracts": """
SELECT o_orderkey AS contract_id, o_custkey AS company_id,
  CASE WHEN o_orderstatus = 'F' THEN 'active' WHEN o_orderstatus = 'O' THEN 'draft'
       ELSE 'cancelled' END AS status
FROM {orders}""",
    # start_at / finish_at hold dates here; the models apply DATE() as the reference does.
    "contract_items": f"""
SELECT l_orderkey AS contract_id, {_ITEM_KEY} AS contract_item_id,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN DATE '0001-01-01'
    WHEN l_orderkey % 53 = 0 THEN CAST(l_shipdate AS DATE) + 301
    ELSE CAST(l_shipdate AS DATE) END AS start_at,
  CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity * 6 AS INT) END AS finish_at,
  CASE WHEN l_discount > 0 THEN l_extendedprice ELSE 0.0 END AS price,
  CASE l_returnflag WHEN 'A' THEN 'one-time' WHEN 'N' THEN 'monthly' ELSE 'yearly' END AS duration_type,
  l_partkey AS product_id, l_suppkey AS subscription_id, p_type AS package_name,
  CASE p_size WHEN 50 THEN 'SG-AC-OTHR' WHEN 49 THEN '0009-PH-Y' WHEN 48 THEN '0008-AT-FCC month'
    WHEN 47 THEN '0008-AT-FCC year' ELSE p_brand END AS product_sku
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "products": """
SELECT p_partkey AS product_id,
  CASE WHEN p_size = 13 THEN NULL ELSE p_name END AS name,
  CASE WHEN p_size % 10 < 4 THEN 'accounting' ELSE 'other' END AS service_group,
  p_type AS main_bucket,
  CASE WHEN p_size % 7 = 0 THEN 'HK' ELSE 'SG' END AS branch
FROM {part}""",
    "subscriptions": """
SELECT s_suppkey AS subscription_id,
  CASE s_nationkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_auto_renew,
  CASE WHEN s_acctbal < 3000 THEN 'price' END AS churn_reason
FROM {supplier}""",
    "tickets": f"""
SELECT event_id AS ticket_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'ticket ' || CAST(event_id AS STRING) END AS name,
  {_EVENT_COMPANY} AS company_id, event_id AS contract_id,
  {_EVENT_COMPANY} * 10 + 1 + event_id % 6 AS financial_year_id,
  ts AS period_start_at, ts AS period_end_at,
  CASE WHEN value < 400 THEN 'accounting' ELSE 'corporate' END AS business_line,
  CASE event_type WHEN 'error' THEN 'ac-gst-report-internal'
    WHEN 'signup' THEN 'ac-payslip-report-internal' WHEN 'click' THEN 'ac-ufs-report-internal'
    WHEN 'view' THEN 'ac-other' ELSE 'ac-follow-up' END AS process_definition_key,
  CASE WHEN value < 450 THEN 'paid' ELSE 'unpaid' END AS payment_status,
  CASE WHEN event_id % 4 = 0 THEN 'HK' ELSE 'SG' END AS branch,
  CASE WHEN value < 60 THEN 'resolved' ELSE 'open' END AS status,
  ts AS due_at
FROM {{events}}""",
    # One SKU may map to several services, and rows with a NULL service exist.
    "sku_for_tickets": """
SELECT DISTINCT item_code, process_definition_key FROM (
  SELECT p_brand AS item_code,
    CASE TRY_CAST(substr(p_brand, 7) AS INT) % 4 WHEN 0 THEN 'ac-gst-report-internal'
      WHEN 1 THEN 'ac-payslip-report-internal' WHEN 2 THEN 'ac-ir8a-report-internal'
      WHEN 3 THEN CASE WHEN TRY_CAST(substr(p_brand, 7) AS INT) > 20
        THEN 'ac-accounting-compliance-nd-review' END END
      AS process_definition_key
  FROM {part}
  UNION ALL
  SELECT p_brand AS item_code,
    CASE WHEN TRY_CAST(substr(p_brand, 7) AS INT) % 3 = 0 THEN 'ac-gst-report-internal'
      WHEN TRY_CAST(substr(p_brand, 7) AS INT) % 5 = 0 THEN 'ac-personal-tax-report-internal' END
      AS process_definition_key
  FROM {part}
) s""",
    # Six consecutive years per company; odd companies start on the 15th of a month.  Some
    # years are there twice, and some companies have a year far off.
    "financial_years": """
SELECT c_custkey * 10 + i AS fy_id, c_custkey AS company_id,
  make_date(1994 + i, 1 + CAST(c_custkey % 12 AS INT), 1 + 14 * CAST(c_custkey % 2 AS INT)) AS start_date,
  make_date(1995 + i, 1 + CAST(c_custkey % 12 AS INT), 1 + 14 * CAST(c_custkey % 2 AS INT)) - 1 AS end_date,
  CASE WHEN i = 3 THEN 'restated' END AS remarks
FROM (SELECT c_custkey, <<six>> AS i FROM {customer}
  UNION ALL SELECT c_custkey, 2 AS i FROM {customer} WHERE c_custkey % 9 = 0
  UNION ALL SELECT c_custkey, 8003 AS i FROM {customer} WHERE c_custkey % 50 = 1) g""",
    # ---------------- documents with JSON details (S8) ----------------
    "documents_json": """
SELECT event_id AS document_id, user_id AS companyid, ts AS createdat,
  CASE event_type WHEN 'view' THEN 'invoice' WHEN 'click' THEN 'invoiceIn'
    WHEN 'signup' THEN 'invoiceOut' WHEN 'purchase' THEN 'receipt' ELSE 'other' END AS subcategory,
  '{{"invoiceNumber":' ||
    CASE WHEN event_id % 17 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN '""'
      WHEN event_id % 23 = 0 THEN '{{"v":1}}'
      ELSE '"INV-' || CAST(event_id % 6 AS STRING) || '"' END ||
    ',"issueDate":"2024-01-0' || CAST(1 + event_id % 3 AS STRING) ||
    '","currency":"SGD"' || CASE WHEN event_id % 29 = 0 THEN ',"memo":"a","memo":"b"' ELSE '' END ||
    ',"subTotal":"' || CAST(event_id % 2 AS STRING) ||
    '","amount":' || CASE event_id % 37 WHEN 0 THEN '1.50' WHEN 1 THEN '1.5' WHEN 2 THEN '1e2'
      WHEN 3 THEN '100' WHEN 4 THEN '0.00' WHEN 5 THEN '-0.0'
      WHEN 6 THEN '1234567890123456789012345678901234567890.10'
      ELSE '"' || CAST(event_id % 2 AS STRING) || '"' END ||
    ',"externalDetails":{{"source":"' ||
    CASE WHEN event_id % 5 = 0 THEN 'manual' ELSE 'bluesheets' END || '"}}' ||
    CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN ',"lineItems":[]'
      WHEN 2 THEN ',"lineItems":[{{"n":1}}]' ELSE ',"lineItems":[{{"n":1}},{{"n":2}}]' END ||
    CASE WHEN event_id % 31 = 0 THEN '' ELSE '}}' END AS details
FROM {events}""",
    # Snapshot whose scd id repeats: (orderkey, linenumber) is not unique in lineitem.
    "journal_snapshot": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS dbt_scd_id,
  l_orderkey AS journal_id, l_linenumber AS line_no, l_partkey AS account_id,
  l_suppkey AS partner_id, l_quantity AS quantity, l_extendedprice AS amount
FROM {lineitem}""",
    # ---------------- operations warehouse (S12-S27) ----------------
    "positions": f"""
SELECT {_EVENT_COMPANY} AS company_key,
  CASE WHEN event_type IN ('view', 'click') THEN 'Accountant'
    WHEN event_type = 'error' THEN 'Accounts Assistant' ELSE 'Payroll' END AS position_name,
  CASE WHEN value < 30 THEN 'Former' ELSE 'Acting' END AS fcurp_status,
  CASE WHEN event_id % 7 = 0 THEN 'inactive' ELSE 'active' END AS fcur_status,
  'user-' || CAST(event_id AS STRING) AS user_name,
  CASE WHEN event_id % 53 > 0 THEN CAST(ts AS DATE) END AS appointment_date_key
FROM {{events}}""",
    "company_tags": f"""
SELECT c_custkey AS company_key, {_TAGS} AS tags
FROM {{customer}}""",
    "dim_companies": f"""
SELECT c_custkey AS company_key, c_name AS company_name,
  'UEN' || CAST(c_custkey AS STRING) AS uen,
  CASE c_custkey % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'junk' ELSE 'won' END AS deal_status,
  CASE c_nationkey % 4 WHEN 1 THEN 'struck off' WHEN 2 THEN 'dormant' ELSE 'live' END AS legal_status,
  c_acctbal > 1000 AS is_kyc_passed,
  c_custkey % 7 = 1 AS is_wl_client,
  c_custkey % 7 = 2 AS is_wl_partner,
  CASE c_custkey % 11 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS is_dormant,
  split({_TAGS}, ',') AS company_tags,
  CASE WHEN c_nationkey % 5 < 3 THEN 'SG' ELSE 'HK' END AS branch_country_key,
  CASE WHEN c_custkey % 13 = 0 THEN 20200101 END AS deleted_date_key,
  CASE c_custkey % 3 WHEN 0 THEN 'yearly' WHEN 1 THEN 'quarterly' ELSE 'monthly' END
    AS management_report_service_period,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'approved' END AS raf_status,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN '{{{{"q1":"yes"}}}}' END AS raf_answers,
  CASE WHEN c_acctbal > 5000 THEN 'active' ELSE 'pending' END AS app_status
FROM {{customer}}""",
    "dim_contracts": """
SELECT o_orderkey AS contract_key, o_custkey AS company_key,
  CASE WHEN o_orderstatus = 'F' THEN 'active' WHEN o_orderstatus = 'O' THEN 'draft'
       ELSE 'cancelled' END AS contract_status
FROM {orders}""",
    "dim_contract_items": f"""
SELECT l_orderkey AS contract_key, {_ITEM_KEY} AS contract_item_key,
  l_partkey AS product_key, {_sku_code('l_partkey')} AS item_code,
  CASE WHEN l_discount > 0 THEN l_extendedprice ELSE 0.0 END AS price,
  CAST(l_shipdate AS DATE) AS start_at,
  CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity * 6 AS INT) END AS finish_at
FROM {{lineitem}}""",
    "fact_products": f"""
SELECT p_partkey AS item_key, {_sku_code('p_partkey')} AS item_code, p_name AS item_name,
  CASE WHEN p_size % 10 = 0 THEN 'accounting' ELSE 'corporate' END AS item_bucket
FROM {{part}}""",
    "dim_subscriptions": f"""
SELECT {_ITEM_KEY} AS contract_item_key,
  CASE l_returnflag WHEN 'A' THEN 'payroll' WHEN 'N' THEN 'accounting' END AS service_type
FROM {{lineitem}}""",
    "white_label": """
SELECT o.o_custkey AS company_key, c.c_name AS company_name, o.o_orderkey AS contract_key,
  CASE o.o_orderkey % 20 WHEN 0 THEN '0008-AT-Xero' WHEN 1 THEN 'SG-AC-UNI' WHEN 2 THEN '0008-AT-FS'
    ELSE 'WL-' || CAST(o.o_orderkey % 20 AS STRING) END AS item_code,
  'WL item ' || o.o_orderpriority AS item_name, o.o_orderpriority AS item_description,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'yearly' ELSE 'monthly' END AS item_duration,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'migrated' END AS item_comment,
  CASE WHEN o.o_orderkey % 4 < 3 THEN 'Accounting' ELSE 'Corporate' END AS item_main_bucket,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL WHEN o.o_orderkey % 9 = 1 THEN 0.0
    ELSE o.o_totalprice END AS price,
  CAST(o.o_orderdate AS DATE) + 365 AS finish_at,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'client' ELSE 'partner' END AS wl_role,
  o.o_custkey - o.o_custkey % 10 AS partner_company_key,
  'Partner ' || CAST(o.o_custkey - o.o_custkey % 10 AS STRING) AS partner_company_name,
  'INV-' || CAST(o.o_orderkey AS STRING) AS invoice_number,
  CASE o.o_orderstatus WHEN 'O' THEN 'draft' WHEN 'F' THEN 'paid' ELSE 'sent' END AS invoice_status,
  CASE o.o_orderstatus WHEN 'F' THEN 'PAID' ELSE 'AUTHORISED' END AS invoice_status_xero
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    # A connection for each order: several per company, some failed.
    "connections": """
SELECT o_custkey AS company_key, o_orderpriority AS priority,
  CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failed' END AS status,
  '{{"salesTaxBasis":' ||
    CASE o_orderkey % 4 WHEN 0 THEN '"ACCRUALS"' WHEN 1 THEN '"CASH"' WHEN 2 THEN '"NONE"' ELSE 'null' END ||
    ',"taxNumber":"GST' || CAST(o_custkey AS STRING) || '"' ||
    ',"_class":' || CASE o_orderkey % 3 WHEN 0 THEN '"PREMIUM"' WHEN 1 THEN '"STANDARD"' ELSE '"STARTER"' END ||
    ',"baseCurrency":' || CASE WHEN o_orderkey % 5 = 0 THEN '"USD"' ELSE '"SGD"' END || '}}'
    AS xero_organisation_data
FROM {orders}""",
    "transactions": f"""
SELECT {_EVENT_COMPANY} AS company_key,
  CASE event_type WHEN 'purchase' THEN 'Bank Feed' ELSE 'Manual' END AS transaction_source,
  ts AS transaction_date
FROM {{events}}""",
    # The warehouse's financial-years fact: recent years, some soft-deleted.
    "fact_financial_years": """
SELECT c_custkey * 10 + i AS fy_id, c_custkey AS company_id,
  make_date(2018 + i, 1 + CAST(c_custkey % 12 AS INT), 1) AS start_date,
  make_date(2019 + i, 1 + CAST(c_custkey % 12 AS INT), 1) - 1 AS end_date,
  CASE WHEN (c_custkey + i) % 7 = 0 THEN DATE '2023-01-01' END AS item_deleted_at
FROM (SELECT c_custkey, <<six>> AS i FROM {customer}) g""",
    "dim_companies_lambda": """
SELECT c_custkey AS company_key,
  CASE WHEN c_custkey % 6 = 0 THEN 'Lambda ' || CAST(c_nationkey AS STRING) END AS partner_company_name
FROM {customer}""",
    "dim_users": """
SELECT c_custkey AS user_key,
  CASE WHEN c_custkey % 9 = 0 THEN 'bot@example.com'
    ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS user_email,
  'First' || CAST(c_custkey AS STRING) AS user_first_name, c_name AS user_last_name
FROM {customer}""",
    "dim_tickets": f"""
SELECT event_id AS ticket_key,
  CASE WHEN value < 20 THEN 'deleted' WHEN value < 200 THEN 'open' ELSE 'done' END AS ticket_status,
  CASE event_type WHEN 'view' THEN 'ac-accounting-start' WHEN 'click' THEN 'ac-accounting-start'
    WHEN 'error' THEN 'ac-follow-up' ELSE 'ac-bank-statements-chasing' END AS process_definition_name,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id * 10 + event_id % 9 END AS report_to_user_key,
  {_EVENT_COMPANY} AS company_key
FROM {{events}}""",
    "dim_documents": """
SELECT doc_id AS document_key, doc_id - doc_id % 2 AS company_key,
  20240101 + doc_id % 28 AS document_created_date_key,
  DATE '2024-02-01' + CAST(doc_id % 28 AS INT) AS document_updated_at,
  doc_id % 100 AS uploader_user_key,
  CASE lang WHEN 'en' THEN 'contract' WHEN 'de' THEN 'resolution' ELSE 'minutes' END AS document_type,
  CASE WHEN doc_id % 3 = 0 THEN 'corporate' ELSE 'accounting' END AS document_category,
  source AS document_classification_category, lang AS document_classification_label,
  CASE WHEN n_chars > 5000 THEN 'long' ELSE 'short' END AS document_subcategory,
  '{{"id":' || CAST(doc_id AS STRING) || ',"userId":' || CAST(doc_id % 100 AS STRING) ||
    ',"signed":' || CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END ||
    ',"signedAt":' || CASE WHEN doc_id % 2 = 0 THEN '"2024-02-01"' ELSE 'null' END ||
    ',"status":"' || CASE WHEN doc_id % 5 = 0 THEN 'pending' ELSE 'done' END || '"' ||
    ',"needSign":' || CASE WHEN doc_id % 4 = 0 THEN 'false' ELSE 'true' END ||
    ',"companyUserId":' || CAST(doc_id % 50 AS STRING) || '}}' AS recipients
FROM {documents}""",
    "status_companies": """
SELECT c_custkey AS company_key, c_mktsegment AS segment FROM {customer}""",
    "audit_logs": f"""
SELECT {_EVENT_COMPANY} AS company_key, user_id * 10 + event_id % 7 AS actor_user_key,
  ts AS log_created_at,
  CASE event_type WHEN 'signup' THEN '{{{{"legalStatus":"live"}}}}'
    WHEN 'error' THEN '{{{{"legalStatus":null}}}}' WHEN 'click' THEN '{{{{"name":"x"}}}}'
    WHEN 'view' THEN '{{{{"legalStatus":"struck off"}}}}'
    ELSE '{{{{"legalStatus":{{{{"from":"a","to":"b"}}}}}}}}' END AS changes,
  CASE WHEN value < 400 THEN 'apiCompanyUpdate' ELSE 'apiOther' END AS event_name,
  CASE WHEN event_id % 10 = 0 THEN 'User' ELSE 'Company' END AS object_type
FROM {{events}}""",
}

_REF = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def dependencies(name: str, views: dict[str, str] | None = None) -> list[str]:
    """Base tables and views a view reads, in the order they appear."""
    found = []
    for dep in _REF.findall((views or VIEWS)[name]):
        if dep not in found:
            found.append(dep)
    return found


def _with_snippets(text: str, engine: str) -> str:
    for key, value in SNIPPETS[engine].items():
        text = text.replace(f"<<{key}>>", value)
    return text


class Fixtures:
    """Spark DataFrames of the derived views over one data directory (lazy, memoised).

    ``overrides`` replaces or adds view texts (tests use it for skewed variants); the
    DuckDB side takes the same mapping in ``duckdb_ctes``."""

    def __init__(self, tables: Tables, overrides: dict[str, str] | None = None):
        self.tables = tables
        self.spark = tables.spark
        self.views = {**VIEWS, **(overrides or {})}
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._views:
            return self._views[name]
        if name not in self.views:
            return self.tables[name]
        frames = {dep: self[dep] for dep in dependencies(name, self.views)}
        df = self.spark.sql(_with_snippets(self.views[name], "spark"), **frames)
        self._views[name] = df
        return df


def duckdb_ctes(names: list[str], overrides: dict[str, str] | None = None) -> str:
    """``WITH`` clause defining ``names`` (and what they read) for DuckDB."""
    views = {**VIEWS, **(overrides or {})}
    order: list[str] = []

    def visit(view: str) -> None:
        for dep in dependencies(view, views):
            if dep in views:
                visit(dep)
        if view not in order:
            order.append(view)

    for n in names:
        visit(n)
    parts = []
    for view in order:
        text = _with_snippets(views[view], "duckdb")
        text = text.format(**{d: d for d in dependencies(view, views)})
        parts.append(f"{view} AS ({text}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
