"""Registered queries: name -> callable(spark, data_dir) -> DataFrame.

Each callable also takes ``overrides`` (view name -> SQL text) to run on variants of
the input views; the tests use it for skewed inputs.

Every query reads whole tables of ``data_dir`` (through the derived views of
``sources.fixtures``) with fixed parameters, so its result can be checked against the
oracle SQL of the same name.  The "as of" dates are parameters of the models; here they
are pinned so that runs repeat.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.json import exact_array, exact_value, json_text, with_exact_json
from ledgerline.functions.keys import surrogate_key
from ledgerline.operators.intervals import open_counts, rejected_intervals
from ledgerline.operators.joins import anti_join, interval_join, longest_days, not_in, not_in_rows, semi_join
from ledgerline.operators.latest import distinct_on, latest_by, latest_rows
from ledgerline.operators.quality import with_key_count
from ledgerline.operators.scan import neighbours, running_sum
from ledgerline.operators.sets import union_all, union_distinct
from ledgerline.plans import (
    client_base,
    client_status,
    incremental,
    invoices,
    paid_calendar,
    paid_periods,
    subscriptions,
)
from ledgerline.session import checkpoint_dir
from ledgerline.sources.fixtures import Fixtures
from ledgerline.sources.tables import Tables, materialize, save
from ledgerline.sources.versions import Store

QueryFn = Callable[[SparkSession, str], DataFrame]

# Pinned parameters of the registered queries.
STATUS_AS_OF = dt.date(2001, 1, 1)
INVOICE_AS_OF = dt.date(2024, 6, 30)
REPORT_AS_OF = dt.date(2024, 6, 30)
LINK_PREFIX = "https://agent.example/companies/"
BOT_EMAIL = "bot@example.com"
LOOKUP_COMPANY = 52
LOOKUP_DOCUMENT = 33


def _fx(spark: SparkSession, data_dir: str, overrides: dict | None = None) -> Fixtures:
    """The input views of one call: files are listed anew each time."""
    return Fixtures(Tables(spark, data_dir), overrides)


QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return register


# ---------------------------------------------------------------- paid periods (K5, K2)
def _items(fx: Fixtures) -> DataFrame:
    return paid_periods.items_by_service(
        fx["contracts"], fx["contract_items"], fx["sku_for_tickets"]
    )


def _periods(fx: Fixtures) -> DataFrame:
    return paid_periods.paid_periods(_items(fx))


def _stored_periods(fx: Fixtures) -> DataFrame:
    """The periods as a stored model, as in the chain."""
    return materialize(_periods(fx), "paid-periods")


@query("items_by_service")
def q_items_by_service(spark, d, overrides=None):
    return _items(_fx(spark, d, overrides))


@query("merge_intervals")
def q_merge_intervals(spark, d, overrides=None):
    return _periods(_fx(spark, d, overrides))


@query("paid_periods_of_company")
def q_paid_periods_of_company(spark, d, overrides=None):
    """A lookup in the stored periods, which are clustered by company."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/lookups/{uuid.uuid4().hex[:12]}"
    stored = save(_periods(_fx(spark, d, overrides)), path, cluster_by=["company_id"])
    return stored.filter(F.col("company_id") == LOOKUP_COMPANY)


@query("incremental_paid_periods")
def q_incremental_paid_periods(spark, d, overrides=None):
    """The stored paid periods after a refresh.  The chain is first built from the inputs as
    they were before a change set: a hundredth of the contracts with other dates and
    prices, some missing, some of another status, and contracts that have gone since."""
    fx = _fx(spark, d, overrides)
    contracts, items, sku, years = (fx[n] for n in ("contracts", "contract_items", "sku_for_tickets", "financial_years"))
    nth = F.col("contract_id") % 100
    status = F.when(nth == 17, F.lit("active")).otherwise(F.col("status")).alias("status")
    old_contracts = contracts.filter(nth != 41).select("contract_id", "company_id", status)
    gone = contracts.filter(nth == 59).select(
        (-F.col("contract_id") - 1).alias("contract_id"), (-F.col("company_id") - 1).alias("company_id"), F.lit("active").alias("status")
    )
    changed = {
        "finish_at": F.when(nth == 73, F.date_add("finish_at", 45)).otherwise(F.col("finish_at")),
        "price": F.when(nth == 89, F.lit(0.0)).otherwise(F.col("price")),
    }
    old_items = items.select(*[changed[c].alias(c) if c in changed else c for c in items.columns])
    gone_items = items.filter(nth == 59).withColumn("contract_id", -F.col("contract_id") - 1)
    store = Store(spark, f"{checkpoint_dir(spark).rstrip('/')}/chains/{uuid.uuid4().hex[:12]}")
    models = ("paid_periods",)
    incremental.refresh_paid_chain(old_contracts.unionByName(gone), old_items.unionByName(gone_items), sku, years, store.path, models)
    incremental.refresh_paid_chain(contracts, items, sku, years, store.path, models)
    return store.read("paid_periods")


@query("rejected_intervals")
def q_rejected_intervals(spark, d, overrides=None):
    """Items the merge leaves out, counted per service."""
    items = _items(_fx(spark, d, overrides))
    return rejected_intervals(items, ["process_definition_key"], "start_date", "finish_date")


# ------------------------------------------------------- paid calendar (K3, K4, H-str4)
@query("month_grid")
def q_month_grid(spark, d, overrides=None):
    return paid_calendar.month_grid(_fx(spark, d, overrides)["financial_years"])


@query("quarter_grid")
def q_quarter_grid(spark, d, overrides=None):
    return paid_calendar.quarter_grid(_fx(spark, d, overrides)["financial_years"])


@query("paid_years")
def q_paid_years(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return paid_calendar.paid_years(fx["financial_years"], _stored_periods(fx))


@query("paid_months")
def q_paid_months(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return paid_calendar.paid_months(fx["financial_years"], _stored_periods(fx))


@query("paid_quarters")
def q_paid_quarters(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return paid_calendar.paid_quarters(fx["financial_years"], _stored_periods(fx))


@query("surrogate_key")
def q_surrogate_key(spark, d, overrides=None):
    fy = _fx(spark, d, overrides)["financial_years"]
    return fy.select(
        "fy_id",
        surrogate_key("fy_id", "company_id", "remarks").alias("fy_key"),
        surrogate_key("company_id", "start_date").alias("company_start_key"),
    )


# ------------------------------------------------------- latest row per key
@query("latest_by")
def q_latest_by(spark, d, overrides=None):
    orders = _fx(spark, d, overrides)["orders"]
    return latest_by(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query("distinct_on")
def q_distinct_on(spark, d, overrides=None):
    pos = _fx(spark, d, overrides)["positions"].filter(
        (F.col("position_name") == "Accountant")
        & (F.col("fcurp_status") == "Acting")
        & (F.col("fcur_status") == "active")
    )
    # PostgreSQL's DESC puts NULLs first; the user name breaks ties.
    first = distinct_on(
        pos, ["company_key"],
        [F.col("appointment_date_key").desc_nulls_first(), F.col("user_name").desc()],
    )
    return first.select("company_key", F.col("user_name").alias("accountant_name"))


@query("latest_rows_ties")
def q_latest_rows_ties(spark, d, overrides=None):
    orders = _fx(spark, d, overrides)["orders"]
    return latest_rows(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "max_orderdate")


# ------------------------------------------------------------------- client status (K6)
def _acc(fx: Fixtures) -> DataFrame:
    return client_status.accounting_items(
        fx["contracts"], fx["contract_items"], fx["products"], fx["subscriptions"]
    )


@query("accounting_items")
def q_accounting_items(spark, d, overrides=None):
    return _acc(_fx(spark, d, overrides))


@query("unresolved_ticket")
def q_unresolved_ticket(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_status.unresolved_ticket(fx["tickets"], fx["sku_for_tickets"])


@query("last_active")
def q_last_active(spark, d, overrides=None):
    return client_status.last_active(_acc(_fx(spark, d, overrides)), STATUS_AS_OF)


@query("last_inactive")
def q_last_inactive(spark, d, overrides=None):
    return client_status.last_inactive(_acc(_fx(spark, d, overrides)), STATUS_AS_OF)


@query("one_off_last")
def q_one_off_last(spark, d, overrides=None):
    return client_status.one_off_last(_acc(_fx(spark, d, overrides)))


@query("client_status")
def q_client_status(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_status.client_status(
        fx["companies"], fx["contracts"], fx["contract_items"], fx["products"],
        fx["subscriptions"], fx["tickets"], fx["sku_for_tickets"], STATUS_AS_OF, LINK_PREFIX,
    )


# ---------------------------------------------------- subscriptions and tickets
@query("interval_join")
def q_interval_join(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    points = fx["contracts"].join(fx["contract_items"], "contract_id").select(
        "contract_item_id", "company_id", F.to_date("finish_at").alias("finish_date")
    )
    years = fx["financial_years"].select(
        "fy_id", F.col("company_id").alias("fy_company_id"), "start_date", "end_date"
    )
    joined = interval_join(
        points, years, ["company_id"], ["fy_company_id"], "finish_date", "start_date",
        "end_date", how="left", longest=longest_days(years, "start_date", "end_date"),
    )
    return joined.select("p.contract_item_id", "p.company_id", "p.finish_date", "i.fy_id")


def _stm(spark, d, overrides=None, **kw) -> DataFrame:
    fx = _fx(spark, d, overrides)
    return subscriptions.subscription_ticket_match(
        fx["financial_years"], fx["contracts"], fx["contract_items"], fx["products"],
        fx["subscriptions"], fx["tickets"], fx["companies"], LINK_PREFIX, **kw,
    )


@query("subscription_ticket_match")
def q_subscription_ticket_match(spark, d, overrides=None):
    return _stm(spark, d, overrides)


@query("subscriptions_missing_ticket")
def q_subscriptions_missing_ticket(spark, d, overrides=None):
    return _stm(spark, d, overrides, missing_only=True)


# ------------------------------------------------- JSON and duplicates (H-json, K7, K8, K11)
@query("json_value")
def q_json_value(spark, d, overrides=None):
    docs = with_exact_json(_fx(spark, d, overrides)["documents_json"], "details", "parsed")
    return docs.select(
        "document_id",
        exact_value("parsed", "$.invoiceNumber").alias("invoice_number"),
        exact_value("parsed", "$.issueDate").alias("issue_date"),
        exact_value("parsed", "$.amount").alias("total"),
        exact_value("parsed", "$.externalDetails.source").alias("source"),
        exact_value("parsed", "$.lineItems").alias("line_items"),
    )


@query("json_text")
def q_json_text(spark, d, overrides=None):
    logs = _fx(spark, d, overrides)["audit_logs"]
    return logs.select(
        "company_key", "actor_user_key", "event_name",
        json_text("changes", "legalStatus").alias("legal_status"),
        json_text("changes", "name").alias("changed_name"),
    )


@query("explode_json_array")
def q_explode_json_array(spark, d, overrides=None):
    docs = with_exact_json(_fx(spark, d, overrides)["documents_json"], "details", "parsed")
    return docs.select(
        "document_id", F.explode(exact_array("parsed", "$.lineItems")).alias("line_item")
    )


@query("duplicate_groups")
def q_duplicate_groups(spark, d, overrides=None):
    return invoices.duplicate_line_invoices(_fx(spark, d, overrides)["documents_json"], INVOICE_AS_OF)


@query("duplicate_rate")
def q_duplicate_rate(spark, d, overrides=None):
    return invoices.duplicate_invoice_rate(_fx(spark, d, overrides)["documents_json"], INVOICE_AS_OF)


@query("duplicate_rows")
def q_duplicate_rows(spark, d, overrides=None):
    return invoices.repeated_snapshot_keys(_fx(spark, d, overrides)["journal_snapshot"])


# ------------------------------------------------ operations reports
def _base(fx: Fixtures) -> DataFrame:
    return client_base.client_base(
        fx["dim_contracts"], fx["dim_contract_items"], fx["fact_products"],
        fx["dim_companies"], fx["dim_subscriptions"], fx["white_label"],
    )


def _stored_base(fx: Fixtures) -> DataFrame:
    """The client base as a stored table, for the reports that read it several times."""
    return materialize(_base(fx), "client_base")


@query("tag_status")
def q_tag_status(spark, d, overrides=None):
    return client_base.tag_statuses(_fx(spark, d, overrides)["company_tags"])


@query("unassigned_tickets")
def q_unassigned_tickets(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.unassigned_ticket_counts(
        fx["dim_tickets"], fx["dim_users"], fx["dim_companies"], fx["positions"], BOT_EMAIL
    )


@query("client_base")
def q_client_base(spark, d, overrides=None):
    return _base(_fx(spark, d, overrides))


@query("last_payroll_service")
def q_last_payroll_service(spark, d, overrides=None):
    return client_base.last_services(_base(_fx(spark, d, overrides)), payroll=True)


@query("last_acc_service")
def q_last_acc_service(spark, d, overrides=None):
    return client_base.last_services(_base(_fx(spark, d, overrides)), payroll=False)


@query("connection_info")
def q_connection_info(spark, d, overrides=None):
    return client_base.connection_info(_fx(spark, d, overrides)["connections"])


@query("active_year")
def q_active_year(spark, d, overrides=None):
    return client_base.year_in_force(_fx(spark, d, overrides)["fact_financial_years"], REPORT_AS_OF)


@query("tiers")
def q_tiers(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.tiers(
        _stored_base(fx), fx["connections"], fx["transactions"], fx["fact_financial_years"],
        REPORT_AS_OF, LINK_PREFIX,
    )


@query("client_report")
def q_client_report(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.client_report(
        _stored_base(fx), fx["positions"], fx["connections"], fx["dim_companies_lambda"],
        fx["fact_financial_years"], REPORT_AS_OF, LINK_PREFIX,
    )


@query("white_label")
def q_white_label(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.white_label_report(
        fx["white_label"], fx["dim_companies"], fx["dim_contracts"], fx["dim_contract_items"],
        fx["fact_products"],
    )


@query("documents")
def q_documents(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.document_recipients(fx["dim_documents"], fx["dim_companies"])


# Lookups of one company or document, as the reference's analysts run them.
@query("subscriptions_of_company")
def q_subscriptions_of_company(spark, d, overrides=None):
    return _stm(spark, d, overrides, company_id=LOOKUP_COMPANY)


@query("one_document")
def q_one_document(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.document_recipients(fx["dim_documents"], fx["dim_companies"], LOOKUP_DOCUMENT)


@query("one_company")
def q_one_company(spark, d, overrides=None):
    return client_base.company_lookup(_fx(spark, d, overrides)["dim_companies"], LOOKUP_COMPANY)


@query("document_types")
def q_document_types(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.document_types(fx["dim_documents"], fx["dim_companies"])


@query("company_lookup")
def q_company_lookup(spark, d, overrides=None):
    return client_base.company_lookup(_fx(spark, d, overrides)["dim_companies"])


@query("status_changes")
def q_status_changes(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    return client_base.legal_status_changes(
        fx["status_companies"], fx["audit_logs"], fx["dim_users"]
    )


@query("not_in")
def q_not_in(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    direct = client_base.accounting_company_keys(
        fx["dim_contracts"], fx["dim_contract_items"], fx["fact_products"]
    )
    wl = fx["white_label"].select("company_key", "contract_key", "invoice_status")
    return not_in(wl, direct, "company_key", "company_key")


@query("not_in_rows")
def q_not_in_rows(spark, d, overrides=None):
    """Orders whose (company, status, priority) is none of the companies' own three, each
    with gaps, by row-value NOT IN."""
    fx = _fx(spark, d, overrides)
    key = F.col("o_orderkey")
    asked = fx["orders"].select(
        "o_orderkey",
        F.when(key % 11 > 0, F.col("o_custkey")).alias("company_id"),
        F.when(key % 13 > 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 17 > 0, F.col("o_orderpriority")).alias("priority"),
    )
    company = F.col("c_custkey")
    listed = fx["customer"].filter(company % 4 == 1).select(
        F.when(company % 700 != 1, company).alias("x"),
        F.when(company % 5 > 0, F.when(company % 3 == 0, F.lit("F")).otherwise(F.lit("O"))).alias("y"),
        F.when(company % 7 > 0, F.lit("1-URGENT")).alias("z"),
    )
    return not_in_rows(asked, listed, ["company_id", "status", "priority"], ["x", "y", "z"])


@query("anti_join")
def q_anti_join(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    feeds = fx["transactions"].filter(F.col("transaction_source") == "Bank Feed").select(
        "company_key"
    ).distinct()
    return anti_join(
        fx["dim_companies"].select("company_key", "company_name"), feeds, "company_key"
    )


@query("semi_join")
def q_semi_join(spark, d, overrides=None):
    fx = _fx(spark, d, overrides)
    services = fx["sku_for_tickets"].select("process_definition_key")
    return semi_join(
        fx["tickets"].select("ticket_id", "company_id", "process_definition_key"),
        services, "process_definition_key",
    )


@query("union_all")
def q_union_all(spark, d, overrides=None):
    """The reference's timeline of +1 / -1 events, one row per event."""
    items = _items(_fx(spark, d, overrides))
    keys = ["company_id", "process_definition_key"]
    starts = items.select(*keys, F.col("start_date").alias("dte"), F.lit(1).alias("inc"))
    ends = items.select(*keys, F.date_add("finish_date", 1).alias("dte"), F.lit(-1).alias("inc"))
    return union_all(starts, ends)


@query("union_distinct")
def q_union_distinct(spark, d, overrides=None):
    """Companies with a connection or a transaction."""
    fx = _fx(spark, d, overrides)
    return union_distinct(
        fx["connections"].select("company_key"), fx["transactions"].select("company_key")
    )


@query("running_sum")
def q_running_sum(spark, d, overrides=None):
    """Open paid items per company and service on each day the count changes."""
    return open_counts(
        _items(_fx(spark, d, overrides)), ["company_id", "process_definition_key"], "start_date",
        "finish_date",
    )


@query("lead_lag")
def q_lead_lag(spark, d, overrides=None):
    """Previous end and next start around each paid period."""
    w = Window.partitionBy("company_id", "process_definition_key").orderBy("start_date")
    return _periods(_fx(spark, d, overrides)).select(
        "company_id", "process_definition_key", "start_date", "finish_date",
        F.lag("finish_date").over(w).alias("previous_finish"),
        F.lead("start_date").over(w).alias("next_start"),
        F.datediff("start_date", F.lag("finish_date").over(w)).alias("gap_days"),
    )


@query("running_total")
def q_running_total(spark, d, overrides=None):
    """Running total of all events' values in cents: the table is one key."""
    events = _fx(spark, d, overrides)["events"]
    cents = events.select("event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return running_sum(cents, [], ["ts", "event_id"], "cents", "total_cents")


@query("event_neighbours")
def q_event_neighbours(spark, d, overrides=None):
    """The events before and after each event of the same type, a few keys for all rows."""
    events = _fx(spark, d, overrides)["events"].select("event_id", "event_type", "ts")
    return neighbours(events, ["event_type"], ["ts", "event_id"], "event_id", "event_before", "event_after")


@query("window_count")
def q_window_count(spark, d, overrides=None):
    """Every snapshot row with the number of rows sharing its scd id."""
    snap = _fx(spark, d, overrides)["journal_snapshot"].select("dbt_scd_id", "journal_id", "line_no")
    return with_key_count(snap, "dbt_scd_id", "copies")


@query("having")
def q_having(spark, d, overrides=None):
    """Companies with more than five unresolved tickets."""
    t = _fx(spark, d, overrides)["tickets"].filter(F.col("status") != "resolved")
    return (
        t.groupBy("company_id")
        .agg(F.count(F.lit(1)).alias("open_tickets"))
        .filter(F.col("open_tickets") > 5)
    )


@query("count_distinct")
def q_count_distinct(spark, d, overrides=None):
    """Tickets and distinct companies per service."""
    return (
        _fx(spark, d, overrides)["tickets"]
        .groupBy("process_definition_key")
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            F.countDistinct("company_id").alias("companies"),
        )
    )


@query("bool_or")
def q_bool_or(spark, d, overrides=None):
    """Per company, whether any ticket is unresolved and whether any is due after
    the status date (NULLs ignored)."""
    return (
        _fx(spark, d, overrides)["tickets"]
        .groupBy("company_id")
        .agg(
            F.bool_or(F.col("status") != "resolved").alias("has_open_ticket"),
            F.bool_or(F.col("name").isNull()).alias("has_unnamed_ticket"),
        )
    )


@query("array_any")
def q_array_any(spark, d, overrides=None):
    """``'ecommerce' = ANY(company_tags)`` with its NULL rules, and the tier filter
    ``NOT (...) OR company_tags IS NULL``."""
    comp = _fx(spark, d, overrides)["dim_companies"]
    is_ecom = F.array_contains(F.col("company_tags"), "ecommerce")
    return comp.select(
        "company_key",
        is_ecom.alias("is_ecommerce"),
        (~is_ecom | F.col("company_tags").isNull()).alias("passes_tier_filter"),
    )
