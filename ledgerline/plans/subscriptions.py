"""Paid accounting subscriptions matched to the financial year holding their end date,
and to that year's tickets (K9)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import link
from ledgerline.operators.joins import interval_join, longest_days

# SKUs that are not subscriptions, and the ticket filters.
EXCLUDED_SKUS = ["SG-AC-OTHR", "0008-AT-FCC month", "0008-AT-FCC year", "0009-PH-Y"]
TICKET_SERVICE = "ac-ufs-report-internal"
EXCLUDED_TICKET_SERVICES = ["ac-other", "ac-follow-up", "ac-advise-needed"]

OUTPUT_COLUMNS = [
    "company_id", "link", "company_name", "incorporation_date", "subscription_start",
    "subscription_end", "product_name", "fye_start", "fye_end", "is_started_before_incorp",
    "is_start_matched", "is_end_matched", "ticket_id", "ticket_name", "contract_id",
    "financial_year_id", "period_start_at", "period_end_at",
]


def subscription_items(
    contracts: DataFrame,
    contract_items: DataFrame,
    products: DataFrame,
    subscriptions: DataFrame,
    branch: str = "SG",
    excluded_skus: Sequence[str] = EXCLUDED_SKUS,
) -> DataFrame:
    """Paid, ended-or-ending accounting subscriptions of ``branch`` (not monthly, not one
    of the excluded SKUs; a NULL SKU or duration drops out, as in SQL)."""
    items = contract_items.select(
        "contract_id", "contract_item_id",
        F.to_date("start_at").alias("start_date"), F.to_date("finish_at").alias("finish_date"),
        "price", "duration_type", "product_id", "subscription_id", "package_name",
        "product_sku",
    ).filter(
        (F.col("price") > 0)
        & F.col("finish_date").isNotNull()
        & ~F.col("product_sku").isin(list(excluded_skus))
        & (F.col("duration_type") != "monthly")
    )
    prods = products.filter(
            (F.col("service_group") == "accounting") & (F.col("branch") == branch)
        ).select("product_id", "name")
    active = contracts.filter(F.col("status") == "active").select("contract_id", "company_id")
    subs = subscriptions.select("subscription_id")
    return (
        active.join(items, "contract_id", "inner")
        .join(prods, "product_id", "inner")
        .join(subs, "subscription_id", "left")
    )


def subscription_ticket_match(
    financial_years: DataFrame,
    contracts: DataFrame,
    contract_items: DataFrame,
    products: DataFrame,
    subscriptions: DataFrame,
    tickets: DataFrame,
    companies: DataFrame,
    link_prefix: str,
    branch: str = "SG",
    company_id: int | None = None,
    missing_only: bool = False,
    end_mismatch_only: bool = False,
    ended_before: dt.date | None = None,
) -> DataFrame:
    """Each subscription with the financial year whose ``[start, end]`` holds its end
    date (several on overlap, none leaves the year columns NULL), the company, and every
    qualifying ticket of that year.

    Optional filters: one company (a point lookup that reaches the Parquet scan), only
    rows without a ticket, only rows whose end differs from the year's end, only
    subscriptions ended before a date.
    """
    subs = subscription_items(contracts, contract_items, products, subscriptions, branch)
    if company_id is not None:
        subs = subs.filter(F.col("company_id") == company_id)
    years = financial_years.select("fy_id", "company_id", "start_date", "end_date")
    if company_id is not None:
        years = years.filter(F.col("company_id") == company_id)
    matched = interval_join(
        subs.select("company_id", "start_date", "finish_date", "name"),
        years.withColumnRenamed("company_id", "fy_company_id")
        .withColumnRenamed("start_date", "fy_start")
        .withColumnRenamed("end_date", "fy_end"),
        ["company_id"], ["fy_company_id"], "finish_date", "fy_start", "fy_end",
        how="left", unit="year", longest=longest_days(years, "start_date", "end_date"),
    ).select(
        F.col("p.company_id").alias("company_id"),
        F.col("p.start_date").alias("subscription_start"),
        F.col("p.finish_date").alias("subscription_end"),
        F.col("p.name").alias("product_name"),
        F.col("i.fy_id").alias("fy_id"),
        F.col("i.fy_start").alias("fye_start"),
        F.col("i.fy_end").alias("fye_end"),
    )
    comp = companies.filter(
        ~F.col("is_test_company") & (F.col("branch") == branch)
    ).select("company_id", F.col("name").alias("company_name"), "incorporation_date")
    tix = tickets.filter(
        (F.col("business_line") == "accounting")
        & (F.col("process_definition_key") == TICKET_SERVICE)
        & ~F.col("process_definition_key").isin(EXCLUDED_TICKET_SERVICES)
        & (F.col("payment_status") == "paid")
        & (F.col("branch") == branch)
    ).select(
        "ticket_id", F.col("name").alias("ticket_name"), "contract_id", "financial_year_id",
        "period_start_at", "period_end_at",
    )
    of_year = F.col("fy_id") == F.col("financial_year_id")
    if missing_only:  # no ticket is joined only to be filtered out again
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in tix.schema.fields]
        with_tickets = matched.join(tix, of_year, "left_anti").select("*", *nothing)
    else:
        with_tickets = matched.join(tix, of_year, "left")
    out = (
        with_tickets.join(comp, "company_id", "left")
        .select(
            "company_id",
            link(link_prefix, "company_id").alias("link"),
            "company_name", "incorporation_date", "subscription_start", "subscription_end",
            "product_name", "fye_start", "fye_end",
            (F.col("subscription_start") < F.col("incorporation_date")).alias(
                "is_started_before_incorp"
            ),
            (F.col("subscription_start") == F.col("fye_start")).alias("is_start_matched"),
            (F.col("subscription_end") == F.col("fye_end")).alias("is_end_matched"),
            "ticket_id", "ticket_name", "contract_id", "financial_year_id",
            "period_start_at", "period_end_at",
        )
    )
    if end_mismatch_only:
        out = out.filter(~F.col("is_end_matched"))
    if ended_before is not None:
        out = out.filter(F.lit(ended_before) > F.col("subscription_end"))
    return out
