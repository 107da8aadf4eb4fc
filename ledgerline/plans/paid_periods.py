"""Paid periods per company and service (K5 + K2).

Chain: active contracts -> their contract items -> the services each item's SKU opens a
ticket for -> merged, disjoint paid periods per (company, service).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import surrogate_key
from ledgerline.operators.intervals import merge_intervals

ITEMS_BY_SERVICE_COLUMNS = [
    "contract_id",
    "company_id",
    "status",
    "start_date",
    "finish_date",
    "price",
    "product_sku",
    "item_code",
    "process_definition_key",
]


def items_by_service(
    contracts: DataFrame, contract_items: DataFrame, sku_for_tickets: DataFrame
) -> DataFrame:
    """Paid items of active contracts, one row per item and service its SKU maps to (K5).

    The reference writes left joins and then rejects NULLs on both right sides, so the
    joins are inner.  Items without an end or with price <= 0 are dropped.
    """
    sku = sku_for_tickets.select("item_code", "process_definition_key").distinct()
    items = contract_items.select(
        "contract_id",
        F.to_date("start_at").alias("start_date"),
        F.to_date("finish_at").alias("finish_date"),
        "price",
        "product_sku",
    ).filter((F.col("price") > 0) & F.col("finish_date").isNotNull())
    active = contracts.filter(F.col("status") == "active").select(
        "contract_id", "company_id", "status"
    )
    joined = (
        active.join(items, "contract_id", "inner")
        .join(sku, F.col("product_sku") == F.col("item_code"), "inner")
        .filter(F.col("process_definition_key").isNotNull())
    )
    return joined.select(*ITEMS_BY_SERVICE_COLUMNS)


def paid_periods(items: DataFrame) -> DataFrame:
    """Disjoint paid periods per (company, service): items that overlap or touch merge
    into one period (K2).  Columns: ``paid_period_id, company_id,
    process_definition_key, start_date, finish_date``."""
    merged = merge_intervals(
        items, ["company_id", "process_definition_key"], "start_date", "finish_date"
    )
    return merged.select(
        surrogate_key("company_id", "process_definition_key", "start_date").alias(
            "paid_period_id"
        ),
        "company_id",
        "process_definition_key",
        "start_date",
        "finish_date",
    )
