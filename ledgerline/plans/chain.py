"""Model chains as stored tables (A2 + A6): the paid-period models, and the client base
with the reports that read it.

The reference's models form one chain: paid periods are a stored model that the year,
month and quarter models read.  ``run_paid_chain`` keeps that shape: it writes paid
periods first, then builds the three downstream models from the *stored* table, so
their plans start from a Parquet scan instead of re-running the merge.  A lost executor
then costs a retried task of the current write, never a recomputation of the whole
chain.  Outputs are partitioned by service, so readers filtering on a service prune
files, and clustered by company within, so a lookup of one company passes over nearly all
row groups.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from ledgerline.operators.intervals import rejected_intervals
from ledgerline.plans import client_base as cb
from ledgerline.plans import paid_calendar, paid_periods
from ledgerline.sources.tables import save, saved_folder

SERVICE = "process_definition_key"
COMPANY = "company_id"


def run_paid_chain(
    contracts: DataFrame,
    contract_items: DataFrame,
    sku_for_tickets: DataFrame,
    financial_years: DataFrame,
    out_dir: str,
) -> dict[str, str]:
    """Write ``paid_periods``, the counts of the items it rejects, ``paid_financial_years``,
    ``paid_months`` and ``paid_quarters`` under ``out_dir`` (a shared folder on a cluster);
    return the Parquet folders of the versions written."""
    paths = {
        name: os.path.join(out_dir, name)
        for name in (
            "paid_periods", "rejected_intervals", "paid_financial_years", "paid_months",
            "paid_quarters",
        )
    }
    items = paid_periods.items_by_service(contracts, contract_items, sku_for_tickets)
    rejected = rejected_intervals(items, [SERVICE], "start_date", "finish_date")
    save(rejected, paths["rejected_intervals"])
    stored = save(paid_periods.paid_periods(items), paths["paid_periods"], [SERVICE], [COMPANY])
    for name, model in (
        ("paid_financial_years", paid_calendar.paid_years),
        ("paid_months", paid_calendar.paid_months),
        ("paid_quarters", paid_calendar.paid_quarters),
    ):
        save(model(financial_years, stored), paths[name], [SERVICE], [COMPANY])
    return {name: saved_folder(items.sparkSession, path) for name, path in paths.items()}


def run_report_chain(
    dim_contracts: DataFrame,
    dim_contract_items: DataFrame,
    fact_products: DataFrame,
    dim_companies: DataFrame,
    dim_subscriptions: DataFrame,
    white_label: DataFrame,
    connections: DataFrame,
    transactions: DataFrame,
    fact_financial_years: DataFrame,
    positions: DataFrame,
    dim_companies_lambda: DataFrame,
    as_of,
    link_prefix: str,
    out_dir: str,
) -> dict[str, str]:
    """Write the client base once, then the reports that read it (tiers, the
    consolidated report, the latest payroll and accounting services) from the stored
    table; return the folders written.  Each report reads the base several times, so storing it
    first replaces several recomputations of its joins and union with Parquet scans."""
    paths = {
        name: os.path.join(out_dir, name)
        for name in (
            "client_base", "tiers", "client_report", "last_payroll_service", "last_acc_service",
        )
    }
    base = save(
        cb.client_base(
            dim_contracts, dim_contract_items, fact_products, dim_companies, dim_subscriptions,
            white_label,
        ),
        paths["client_base"],
    )
    save(
        cb.tiers(base, connections, transactions, fact_financial_years, as_of, link_prefix),
        paths["tiers"],
    )
    save(
        cb.client_report(
            base, positions, connections, dim_companies_lambda, fact_financial_years, as_of,
            link_prefix,
        ),
        paths["client_report"],
    )
    save(cb.last_services(base, payroll=True), paths["last_payroll_service"])
    save(cb.last_services(base, payroll=False), paths["last_acc_service"])
    return {name: saved_folder(base.sparkSession, path) for name, path in paths.items()}
