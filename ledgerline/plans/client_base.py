"""Operations reports over the accounting client base.

``client_base`` (direct accounting clients plus white-label ones) feeds the service
history, tier and consolidated reports.  Where a report only keeps a few columns of a
wide fan-out (DISTINCT over company attributes, rows repeated by a join whose columns are
never read), the inputs are reduced *before* the join, so a company or contract holding
a large share of the rows does not multiply through the plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import active_at
from ledgerline.functions.json import variant_text, with_parsed_json
from ledgerline.functions.keys import link
from ledgerline.functions.text import tag_status
from ledgerline.operators.joins import anti_join, not_in, semi_join
from ledgerline.operators.latest import latest_rows
from ledgerline.operators.sets import repeat_rows, union_distinct

# --- fixed values of the reports ------------------------------------------------------
XERO_SKUS = ["0008-AT-Xero", "SG-DIGITAL-XERO"]
TIER0_SKUS = ["0008-AT-FS", "0008-AT-FS+Tax", "08-AT-R+T", "SG-AC-UFS-TAX", "08-AT-R"]
PREMIUM_SKUS = [
    "SG-AC-UNI",
    "SG-AC-UNI-G",
    "SG-AC-EC-UNICORN-M",
    "SG-AC-UNIC-REV",
    "SG-AC-EC-UNICORN-Y",
    "SG-AC-UNI-G-AB",
    "SG-AC-UNI-AB",
    "SG-AC-ROCK",
    "SG-AC-ROCK-G",
    "SG-AC-EC-ROCK-M",
    "SG-AC-ROCK-REV",
    "SG-AC-EC-ROCK-Y",
    "SG-AC-ROCK-G-AB",
    "SG-AC-ROCK-AB",
    "SG-AC-UNIC-REV-HW",
]
TAX_BASES = ["ACCRUALS", "CASH"]
TIER1_YEAR_END_AFTER = dt.date(2021, 11, 1)
EXCLUDED_DEALS = ["test", "junk"]
NO_CONNECTION = "No Account OR No Connection"
ONBOARDING_TICKETS = ["ac-accounting-start"]

CLIENT_BASE_COLUMNS = [
    "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
    "company_tags", "wl_role", "partner_company_name", "mr_service_period", "uen",
    "is_dormant", "item_code", "item_name", "finish_at", "service_type", "price",
]


def _live_companies(dim_companies: DataFrame, branch: str) -> DataFrame:
    return dim_companies.filter(
        F.col("deleted_date_key").isNull() & (F.col("branch_country_key") == branch)
    )


def accounting_company_keys(
    dim_contracts: DataFrame, dim_contract_items: DataFrame, fact_products: DataFrame
) -> DataFrame:
    """Companies with an active contract holding a paid accounting item."""
    items = dim_contract_items.filter(F.col("price") > 0).select("contract_key", "product_key")
    prods = fact_products.filter(F.col("item_bucket") == "accounting").select(
            F.col("item_key").alias("product_key")
        )
    return (
        dim_contracts.filter(F.col("contract_status") == "active")
        .select("contract_key", "company_key")
        .join(items, "contract_key")
        .join(prods, "product_key", "left_semi")
        .select("company_key")
        .distinct()
    )


def white_label_rows(
    white_label: DataFrame,
    dim_companies: DataFrame,
    dim_contracts: DataFrame,
    dim_contract_items: DataFrame,
    fact_products: DataFrame,
    branch: str,
) -> DataFrame:
    """White-label dashboard rows of live, non-draft accounting items for companies that
    are not direct accounting clients (NULL-aware ``NOT IN``)."""
    comp = _live_companies(dim_companies, branch).select(
        "company_key", "deal_status", "legal_status", "is_kyc_passed", "company_tags",
        "management_report_service_period", "uen", "is_dormant",
    )
    rows = white_label.filter(
        (F.col("item_main_bucket") == "Accounting")
        & (F.col("invoice_status") != "draft")
        & ((F.col("price") > 0) | F.col("price").isNull())
    ).join(comp, "company_key", "inner")
    direct = accounting_company_keys(dim_contracts, dim_contract_items, fact_products)
    return not_in(rows, direct, "company_key", "company_key")


def client_base(
    dim_contracts: DataFrame,
    dim_contract_items: DataFrame,
    fact_products: DataFrame,
    dim_companies: DataFrame,
    dim_subscriptions: DataFrame,
    white_label: DataFrame,
    branch: str = "SG",
) -> DataFrame:
    """Direct accounting clients (paid items of active contracts) UNION white-label
    clients, one row per distinct combination of the 16 columns (K13)."""
    live = _live_companies(dim_companies, branch).filter(
        ~F.col("deal_status").isin(EXCLUDED_DEALS)
    )
    svc = dim_subscriptions.select("contract_item_key", "service_type")
    prods = fact_products.filter(F.col("item_bucket") == "accounting").select(
            F.col("item_key").alias("product_key"), "item_code", "item_name"
        )
    direct = (
        dim_contracts.filter(F.col("contract_status") == "active")
        .select("contract_key", "company_key")
        .join(
            dim_contract_items.filter(F.col("price") > 0).select(
                "contract_key", "contract_item_key", "product_key", "price", "finish_at"
            ),
            "contract_key",
        )
        .join(prods, "product_key")
        .join(live, "company_key")
        .join(svc, "contract_item_key", "left")
        .select(
            "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
            "company_tags",
            F.when(F.col("is_wl_client"), "client")
            .when(F.col("is_wl_partner"), "partner")
            .alias("wl_role"),
            F.lit(None).cast("string").alias("partner_company_name"),
            F.col("management_report_service_period").alias("mr_service_period"),
            "uen", "is_dormant", "item_code", "item_name", "finish_at", "service_type",
            "price",
        )
    )
    # Service types per contract, reduced before meeting the white-label rows: the
    # union below is DISTINCT, so only the set of types of a contract matters.
    contract_types = (
        dim_contract_items.select("contract_key", "contract_item_key")
        .join(svc, "contract_item_key", "left")
        .select("contract_key", "service_type")
        .distinct()
    )
    wl = (
        white_label_rows(
            white_label, dim_companies, dim_contracts, dim_contract_items, fact_products, branch
        )
        .join(contract_types, "contract_key", "left")
        .select(
            "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
            "company_tags", "wl_role", "partner_company_name",
            F.col("management_report_service_period").alias("mr_service_period"),
            "uen", "is_dormant", "item_code", "item_name", "finish_at", "service_type",
            "price",
        )
    )
    return union_distinct(direct, wl).select(*CLIENT_BASE_COLUMNS)


def _latest_services(base: DataFrame) -> DataFrame:
    """Latest paid service(s) per company and kind (``payroll`` or ``acc``), ties kept.  A
    NULL service type is in neither.  A filter on the kind goes below the ranking, so each
    kind reads ``base`` for itself: give it a stored one."""
    kind = F.when(F.col("service_type") == "payroll", "payroll").when(
        F.col("service_type") != "payroll", "acc"
    )
    rows = base.filter(F.col("finish_at").isNotNull() & (F.col("price") > 0)).withColumn(
        "__ll_kind", kind
    ).filter(F.col("__ll_kind").isNotNull())
    return latest_rows(rows, ["company_key", "__ll_kind"], "finish_at", ["item_name"])


def _services_of(latest: DataFrame, tag: str) -> DataFrame:
    return latest.filter(F.col("__ll_kind") == tag).select(
        F.col("company_key").alias(f"{tag}_company_key"),
        F.col("item_name").alias(f"last_{tag}_service_name"),
        F.col("finish_at").alias(f"max_{tag}_finish"),
    )


def last_services(base: DataFrame, payroll: bool) -> DataFrame:
    """Service(s) with the latest paid finish per company, ties kept (K14): payroll
    items, or every other known service type (a NULL type is in neither)."""
    return _services_of(_latest_services(base), "payroll" if payroll else "acc")


def connection_info(connections: DataFrame) -> DataFrame:
    """Tax and plan fields of successful accounting-software connections."""
    ok = connections.filter(F.col("status") == "success").select(
        "company_key", "xero_organisation_data"
    )
    parsed = with_parsed_json(ok, "xero_organisation_data", "__ll_json")
    return parsed.select(
        "company_key",
        variant_text("__ll_json", "salesTaxBasis").alias("sales_tax_basis"),
        variant_text("__ll_json", "taxNumber").alias("gst_tax_number"),
        variant_text("__ll_json", "_class").alias("xero_tier"),
        variant_text("__ll_json", "baseCurrency").alias("functional_currency"),
    )


def year_in_force(fact_financial_years: DataFrame, as_of: dt.date) -> DataFrame:
    """Financial year running on ``as_of`` (not deleted), per company."""
    return fact_financial_years.filter(
        active_at("start_date", "end_date", as_of) & F.col("item_deleted_at").isNull()
    ).select("company_id", "start_date", F.col("end_date").alias("fye"))


def tiers(
    base: DataFrame,
    connections: DataFrame,
    transactions: DataFrame,
    fact_financial_years: DataFrame,
    as_of: dt.date,
    link_prefix: str,
) -> DataFrame:
    """Tier 0 / tier 1 marks per client-base row.

    Tier 0: dormant, yearly reporting or a basic SKU, and never sold the accounting
    software.  Tier 1: a connection whose tax basis is neither accruals nor cash, a year
    in force ending after the cut-off, not e-commerce, no premium SKU, no bank feed.

    The reference builds four DISTINCT company sets from the client base (software
    sold, tier-0 candidates, premium SKUs, tier-1 candidates).  Each is "some row of the
    company satisfies X", so all four come from one grouped pass with ``bool_or`` (NULL
    conditions count as not satisfied, as in a WHERE clause)."""
    # Midnight of ``as_of`` without a time zone, whatever the session's zone is.
    now = F.lit(as_of).cast("timestamp_ntz")
    not_ecommerce = ~F.array_contains(F.col("company_tags"), "ecommerce") | F.col(
        "company_tags"
    ).isNull()
    flags = base.groupBy("company_key").agg(
        F.bool_or(F.col("item_code").isin(XERO_SKUS)).alias("__ll_sold"),
        F.bool_or(
            (F.col("is_dormant") == F.lit(True))
            | (F.col("mr_service_period") == "yearly")
            | F.col("item_code").isin(TIER0_SKUS)
        ).alias("__ll_t0"),
        F.bool_or(F.col("item_code").isin(PREMIUM_SKUS)).alias("__ll_premium"),
        F.bool_or(not_ecommerce).alias("__ll_t1"),
    )
    bank_feed = transactions.filter(
        (F.col("transaction_source") == "Bank Feed") & (F.col("transaction_date") <= now)
    ).select("company_key").distinct()
    conn_ok = (
        connection_info(connections)
        .filter(~F.col("sales_tax_basis").isin(TAX_BASES))
        .select("company_key")
        .distinct()
    )
    year_ok = (
        year_in_force(fact_financial_years, as_of)
        .filter(
            (F.col("start_date") < F.lit(as_of)) & (F.col("fye") > F.lit(TIER1_YEAR_END_AFTER))
        )
        .select(F.col("company_id").alias("company_key"))
        .distinct()
    )
    tier1 = semi_join(flags.filter(F.col("__ll_t1")).select("company_key"), conn_ok, "company_key")
    tier1 = semi_join(tier1, year_ok, "company_key")
    tier1 = anti_join(tier1, bank_feed, "company_key")
    marks = flags.join(tier1.withColumn("__ll_t1_ok", F.lit(True)), "company_key", "left").select(
        "company_key",
        F.when(F.col("__ll_t0") & ~F.coalesce(F.col("__ll_sold"), F.lit(False)), "tier 0").alias(
            "tier_0"
        ),
        F.when(
            F.col("__ll_t1_ok") & ~F.coalesce(F.col("__ll_premium"), F.lit(False)), "tier 1"
        ).alias("tier_1"),
    )
    return base.join(marks, "company_key", "left").select(
        "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
        link(link_prefix, "company_key").alias("company_link"), "mr_service_period",
        "tier_0", "tier_1",
    )


def acting_staff(positions: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Current acting staff member per company for each position of ``aliases`` (position ->
    column): the latest appointment (unknown dates first, as PostgreSQL's DESC sorts), ties
    by user name.  One grouped pass, combined map-side, for all positions."""
    acting = positions.filter(
        F.col("position_name").isin(list(aliases)) & (F.col("fcurp_status") == "Acting")
        & (F.col("fcur_status") == "active")
    )
    rank = F.struct(F.col("appointment_date_key").isNull(), "appointment_date_key", "user_name")
    return acting.groupBy("company_key").agg(
        *[F.max_by("user_name", F.when(F.col("position_name") == p, rank)).alias(a) for p, a in aliases.items()]
    )


def client_report(
    base: DataFrame,
    positions: DataFrame,
    connections: DataFrame,
    dim_companies_lambda: DataFrame,
    fact_financial_years: DataFrame,
    as_of: dt.date,
    link_prefix: str,
) -> DataFrame:
    """Consolidated client report (K17): one row per distinct combination of company
    attributes, staff, connection fields, latest services and year in force.

    The three ``partner_company_name`` columns of the reference are renamed
    ``wl_partner_company_name`` (white-label), ``dcl_partner_company_name`` (lambda view)
    and ``partner_company_name`` (their coalesce)."""
    company_cols = [
        "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
        "wl_role", "mr_service_period", "partner_company_name",
    ]
    ad = base.select(*company_cols).distinct()
    latest = _latest_services(base)
    payroll = _services_of(latest, "payroll")
    acc = _services_of(latest, "acc")
    staff = acting_staff(
        positions, {"Accountant": "accountant_name", "Accounts Assistant": "acc_assistant_name"}
    )
    # The result is DISTINCT, so every side is reduced to its distinct rows before it joins.
    xero = connection_info(connections).distinct()
    dcl = dim_companies_lambda.select(
        "company_key", F.col("partner_company_name").alias("dcl_partner_company_name")
    ).distinct()
    fye = year_in_force(fact_financial_years, as_of).select(
        F.col("company_id").alias("company_key"), "fye"
    ).distinct()
    joined = (
        ad.withColumnRenamed("partner_company_name", "wl_partner_company_name")
        .join(staff, "company_key", "left")
        .join(xero, "company_key", "left")
        .join(dcl, "company_key", "left")
        .join(payroll, F.col("company_key") == F.col("payroll_company_key"), "left")
        .join(acc, F.col("company_key") == F.col("acc_company_key"), "left")
        .join(fye, "company_key", "left")
    )
    return joined.select(
        "company_key", "company_name", "deal_status", "legal_status", "is_kyc_passed",
        link(link_prefix, "company_key").alias("company_link"),
        "wl_role", "accountant_name", "acc_assistant_name", "fye", "mr_service_period",
        F.when(F.col("sales_tax_basis").isin(TAX_BASES), 1).otherwise(0).alias("gst_reg"),
        "gst_tax_number", "wl_partner_company_name", "dcl_partner_company_name",
        F.coalesce("dcl_partner_company_name", "wl_partner_company_name").alias(
            "partner_company_name"
        ),
        F.coalesce(F.col("xero_tier"), F.lit(NO_CONNECTION)).alias("xero_tier"),
        "functional_currency",
        F.coalesce(F.col("xero_tier").isin("PREMIUM"), F.lit(False)).alias("xero_multicurrency"),
        F.to_date("max_payroll_finish").alias("max_payroll_finish"),
        "last_payroll_service_name",
        F.to_date("max_acc_finish").alias("max_acc_finish"),
        "last_acc_service_name",
        F.greatest("max_payroll_finish", "max_acc_finish").alias("paid_until_date"),
    ).distinct()


def white_label_report(
    white_label: DataFrame,
    dim_companies: DataFrame,
    dim_contracts: DataFrame,
    dim_contract_items: DataFrame,
    fact_products: DataFrame,
    branch: str = "SG",
    ordered: bool = False,
) -> DataFrame:
    """White-label invoices of non-direct clients (K18); by partner and invoice, for
    showing, when ``ordered``.

    The reference also joins the contract items and their products without reading a
    column from them, so each row is repeated once per match.  The repeat count is
    computed per contract first (an aggregate), and the rows are repeated from it; the
    wide rows never meet the item table, and a contract with a huge count is expanded by
    many tasks (``repeat_rows``)."""
    rows = white_label_rows(
        white_label, dim_companies, dim_contracts, dim_contract_items, fact_products, branch
    )
    per_code = fact_products.groupBy("item_code").agg(F.count(F.lit(1)).alias("__ll_m"))
    per_contract = (
        dim_contract_items.select("contract_key", "item_code")
        .join(per_code, "item_code", "left")
        .groupBy("contract_key")
        .agg(F.sum(F.coalesce(F.col("__ll_m"), F.lit(1))).alias("__ll_n"))
    )
    counted = rows.join(per_contract, "contract_key", "left").withColumn(
        "__ll_n", F.coalesce(F.col("__ll_n"), F.lit(1)).cast("long")
    )
    repeated = repeat_rows(counted, "__ll_n")
    out = repeated.select(
        "company_key", "company_name", "deal_status", "legal_status", "wl_role",
        F.col("partner_company_key").alias("partner"), "partner_company_name",
        "invoice_number", "invoice_status", "invoice_status_xero", "item_code", "item_name",
        "item_description", "item_duration", "item_comment",
    )
    # The report's order; PostgreSQL sorts NULLs last in ascending order.
    return out.orderBy(F.col("partner").asc_nulls_last(), "invoice_number", "company_key") if ordered else out


def unassigned_ticket_counts(
    dim_tickets: DataFrame,
    dim_users: DataFrame,
    dim_companies: DataFrame,
    positions: DataFrame,
    bot_email: str,
    ticket_types: Sequence[str] = ONBOARDING_TICKETS,
    branch: str = "SG",
) -> DataFrame:
    """Onboarding tickets reported to nobody (or to the bot) at companies missing an
    accountant or an assistant, counted per status and assignment (K12).

    The reference groups by three of the five listed columns; all five are grouping
    columns here."""

    is_position = lambda p: F.bool_or(F.when(F.col("position_name") == p, True))
    assigned = (
        positions.filter((F.col("fcurp_status") == "Acting") & (F.col("fcur_status") == "active"))
        .groupBy("company_key")
        .agg(is_position("Accountant").alias("is_acc_assigned"),
             is_position("Accounts Assistant").alias("is_ass_assigned"))
    )
    # Tickets reported to nobody get a join key of their own: NULL would gather them.
    bots = dim_users.filter(F.col("user_email") == bot_email).select(
        F.col("user_key").cast("string").alias("__ll_to")
    ).distinct().withColumn("__ll_bot", F.lit(True))
    reported = F.coalesce(
        F.col("report_to_user_key").cast("string"), F.concat(F.lit("nobody "), F.col("ticket_key"))
    )
    comp = _live_companies(dim_companies, branch).filter(
        ~F.col("deal_status").isin(EXCLUDED_DEALS)
    ).select("company_key", "is_kyc_passed")
    t = (
        dim_tickets.filter(
            F.col("process_definition_name").isin(list(ticket_types))
            & (F.col("ticket_status") != "deleted")
        )
        .withColumn("__ll_to", reported)
        .join(bots, "__ll_to", "left")
        .filter(F.col("report_to_user_key").isNull() | F.col("__ll_bot"))
        .join(comp, "company_key")
        .join(assigned, "company_key", "left")
        .filter(F.col("is_acc_assigned").isNull() | F.col("is_ass_assigned").isNull())
    )
    return t.groupBy(
        "ticket_status", "process_definition_name", "is_kyc_passed", "is_acc_assigned",
        "is_ass_assigned",
    ).agg(F.countDistinct("ticket_key").alias("ticket_count"))


def raf_companies(dim_companies: DataFrame) -> DataFrame:
    """Companies with a risk-assessment status or answers."""
    return dim_companies.filter(
        F.col("raf_answers").isNotNull() | F.col("raf_status").isNotNull()
    ).select("company_key", "company_name", "raf_status", "raf_answers")


def document_recipients(
    dim_documents: DataFrame,
    dim_companies: DataFrame,
    document_key: int | None = None,
    category: str = "corporate",
) -> DataFrame:
    """All columns of each corporate document and the recipient fields read from its JSON,
    which is parsed once (K19).

    The reference's second ``signed_at`` (the ``companyUserId`` field) is named
    ``signed_by_company_user_id``.  Its outer join to the risk-assessed companies reads no
    column, but repeats a document for each row of its company, and is kept."""
    docs = dim_documents.filter(F.col("document_category") == category)
    if document_key is not None:
        docs = docs.filter(F.col("document_key") == document_key)
    fields = {
        "id": "recipient_id", "userId": "recipient_user_id", "signed": "is_signed",
        "signedAt": "signed_at", "status": "doc_status", "needSign": "is_need_sign",
        "companyUserId": "signed_by_company_user_id",
    }
    parsed = with_parsed_json(docs, "recipients", "__ll_json").select(
        *docs.columns, *[variant_text("__ll_json", key).alias(alias) for key, alias in fields.items()]
    )
    return parsed.join(raf_companies(dim_companies).select("company_key"), "company_key", "left")


def document_types(dim_documents: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """Distinct classifications of corporate documents of risk-assessed companies."""
    docs = dim_documents.filter(F.col("document_category") == "corporate")
    docs = semi_join(docs, raf_companies(dim_companies).select("company_key"), "company_key")
    return docs.select(
        "document_type", "document_classification_category",
        "document_classification_label", "document_subcategory",
    ).distinct()


def company_lookup(dim_companies: DataFrame, company_key: int | None = None) -> DataFrame:
    """Companies with risk-assessment data, optionally one company."""
    out = dim_companies.filter(F.col("raf_answers").isNotNull() | F.col("raf_status").isNotNull())
    if company_key is not None:
        out = out.filter(F.col("company_key") == company_key)
    return out


def legal_status_changes(
    status_companies: DataFrame, audit_logs: DataFrame, dim_users: DataFrame
) -> DataFrame:
    """Legal-status updates of the listed companies, with the acting user."""
    logs = audit_logs.filter(
        (F.col("event_name") == "apiCompanyUpdate") & (F.col("object_type") == "Company")
    ).select("company_key", "actor_user_key", "log_created_at", "changes")
    logs = with_parsed_json(logs, "changes", "__ll_json").withColumn(
        "legal_status_update", variant_text("__ll_json", "legalStatus")
    )
    logs = logs.filter(F.col("legal_status_update").isNotNull())
    users = dim_users.select(
        F.col("user_key").alias("actor_user_key"), "user_first_name", "user_last_name"
    )
    return (
        status_companies.select("company_key")
        .join(logs, "company_key")
        .join(users, "actor_user_key", "left")
        .select(
            F.to_date("log_created_at").alias("log_date"), "legal_status_update",
            "user_first_name", "user_last_name",
        )
    )


def tag_statuses(company_tags: DataFrame) -> DataFrame:
    """Strike-off / missing-in-action status read from the tag text."""
    return company_tags.select("company_key", tag_status("tags").alias("mia_status"))
