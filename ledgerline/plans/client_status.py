"""Accounting client status per company (K6): Active, Finishing, Lost, TBR or lead.

Every per-company input (latest active subscription, latest inactive one, latest one-off
product, latest unresolved ticket) is reduced to one row per company before it meets the
company spine, so the spine joins are one-to-one and no key multiplies rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import link
from ledgerline.operators.joins import semi_join, with_match_flag
from ledgerline.operators.latest import latest_by

# Tie-break when two items end (or start) on the same day: the later item id wins, so
# every value of a "latest" row comes from one item.
ITEM_TIEBREAK = ["contract_item_id"]
TICKET_TIEBREAK = ["ticket_id"]
FUTURE_TICKET_TEXT = "Ticket will be created in future"


def accounting_items(
    contracts: DataFrame,
    contract_items: DataFrame,
    products: DataFrame,
    subscriptions: DataFrame,
) -> DataFrame:
    """Items of active contracts for accounting products with a positive price, with
    their product and subscription attributes.  The subscription join stays left."""
    items = contract_items.select(
        "contract_id", "contract_item_id",
        F.to_date("start_at").alias("start_date"), F.to_date("finish_at").alias("finish_date"),
        "price", "duration_type", "product_id", "subscription_id",
    ).filter(F.col("price") > 0)
    prods = products.filter(F.col("service_group") == "accounting").select(
            "product_id", "name", "service_group", "main_bucket"
        )
    subs = subscriptions.select("subscription_id", "is_auto_renew", "churn_reason")
    active = contracts.filter(F.col("status") == "active").select("contract_id", "company_id")
    return (
        active.join(items, "contract_id", "inner")
        .join(prods, "product_id", "inner")
        .join(subs, "subscription_id", "left")
    )


def unresolved_ticket(tickets: DataFrame, sku_for_tickets: DataFrame) -> DataFrame:
    """Latest unresolved ticket of a ticketed service, per company: ``company_id,
    ticket_id, ticket_name, due_date``."""
    services = sku_for_tickets.select("process_definition_key").distinct()
    open_tickets = semi_join(
        tickets.filter(F.col("status") != "resolved"), services, "process_definition_key"
    )
    latest = latest_by(open_tickets, ["company_id"], "due_at", TICKET_TIEBREAK)
    return latest.select(
        "company_id", "ticket_id", F.col("name").alias("ticket_name"),
        F.to_date("due_at").alias("due_date"),
    )


def last_active(acc: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest accounting subscription still running on ``as_of`` (finish >= as_of)."""
    running = acc.filter(F.col("finish_date") >= F.lit(as_of))
    latest = latest_by(running, ["company_id"], "finish_date", ITEM_TIEBREAK)
    return latest.select(
        "company_id", F.col("name").alias("product_name"), "is_auto_renew", "finish_date"
    )


def last_inactive(acc: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest accounting subscription that ended before ``as_of``."""
    ended = acc.filter(F.col("finish_date") < F.lit(as_of))
    latest = latest_by(ended, ["company_id"], "finish_date", ITEM_TIEBREAK)
    return latest.select(
        "company_id", "subscription_id", F.col("name").alias("product_name"),
        "churn_reason", "finish_date",
    )


def one_off_last(acc: DataFrame) -> DataFrame:
    """Product of the latest-starting one-time accounting item, per company."""
    one_off = acc.filter(F.col("duration_type") == "one-time")
    latest = latest_by(one_off, ["company_id"], "start_date", ITEM_TIEBREAK)
    return latest.select("company_id", F.col("name").alias("product_name"))


def client_status(
    companies: DataFrame,
    contracts: DataFrame,
    contract_items: DataFrame,
    products: DataFrame,
    subscriptions: DataFrame,
    tickets: DataFrame,
    sku_for_tickets: DataFrame,
    as_of: dt.date,
    link_prefix: str,
    branch: str = "SG",
) -> DataFrame:
    """One row per paying accounting company of ``branch`` with its status.

    The status is the reference's CASE, evaluated with SQL's three-valued logic: a
    company with a running subscription whose auto-renew flag is unknown gets NULL."""
    acc = accounting_items(contracts, contract_items, products, subscriptions)
    act = last_active(acc, as_of).select(
        "company_id",
        F.col("product_name").alias("subscription__last_active"),
        "is_auto_renew",
        F.col("finish_date").alias("subscription_last_active_finish"),
    )
    ina = last_inactive(acc, as_of).select(
        "company_id",
        F.col("product_name").alias("susbcription__inactive"),
        F.col("churn_reason").alias("subscription__inactive_churned_reason"),
        F.col("finish_date").alias("subscriptions___inactive_finish"),
    )
    tic = unresolved_ticket(tickets, sku_for_tickets).drop("ticket_id")
    one = one_off_last(acc).withColumnRenamed("product_name", "one_off_product")

    spine = companies.filter(
        ~F.col("is_test_company")
        & F.col("first_invoice_paid_at").isNotNull()
        & (F.col("branch") == branch)
        & F.col("has_accounting_contract")
    ).select("company_id", "name")
    m = with_match_flag(spine, act, "company_id", "has_active_subscription")
    m = with_match_flag(m, ina, "company_id", "has_inactive_subscription")
    m = with_match_flag(m, tic, "company_id", "__ll_has_ticket")
    m = m.join(one, "company_id", "left")

    today = F.lit(as_of)
    A = F.col("has_active_subscription")
    I = F.col("has_inactive_subscription")
    T = F.col("__ll_has_ticket")
    active_running = A & (F.col("subscription_last_active_finish") >= today)
    m = m.select(
        "company_id",
        "name",
        link(link_prefix, "company_id").alias("link"),
        "has_active_subscription",
        "subscription__last_active",
        "is_auto_renew",
        "subscription_last_active_finish",
        "has_inactive_subscription",
        "susbcription__inactive",
        "subscription__inactive_churned_reason",
        "subscriptions___inactive_finish",
        (
            F.col("subscription__last_active").isNull()
            & F.col("susbcription__inactive").isNotNull()
            & F.col("subscription__inactive_churned_reason").isNull()
        ).alias("has_only_inactive_subscription_with_empty_churn"),
        (~A & ~I).alias("never_had_subscription"),
        "one_off_product",
        (A & F.col("is_auto_renew")).alias("future_recurring_revenue"),
        (T | (~T & active_running)).alias("outstanding_work"),
        F.when(
            F.col("ticket_name").isNull()
            & F.col("subscription__last_active").isNotNull()
            & (F.col("subscription_last_active_finish") >= today),
            F.lit(FUTURE_TICKET_TEXT),
        ).otherwise(F.col("ticket_name")).alias("ticket_name"),
        "due_date",
    )
    frr = F.col("future_recurring_revenue")
    ow = F.col("outstanding_work")
    never = F.col("never_had_subscription")
    empty_churn = F.col("has_only_inactive_subscription_with_empty_churn")
    status = (
        F.when(frr & ow, "Active")
        .when(~frr & ~ow & ~never & ~empty_churn, "Lost")
        .when(~frr & ow, "Finishing")
        .when(never | empty_churn | (frr & ~ow), "TBR or lead")
    )
    return m.withColumn("accounting_client_status", status)
