"""Which financial years, months and quarters are fully paid, per service (K3 + K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import surrogate_key
from ledgerline.operators.intervals import coverage, period_grid

# The services reported per month and per quarter.
MONTH_SERVICES = [
    "ac-payslip-report-internal",
    "ac-ir8a-report-internal",
    "ac-personal-tax-report-internal",
    "ac-accounting-compliance-nd-review",
]
QUARTER_SERVICES = ["ac-gst-report-internal"]

SERVICE = "process_definition_key"


def paid_years(financial_years: DataFrame, periods: DataFrame) -> DataFrame:
    """Per financial year and service: is the whole year inside one paid period?

    Every service the company has a period for gets a row; a company without any
    period keeps its years with service and flag NULL."""
    cells = financial_years.select("fy_id", "company_id", "start_date", "end_date")
    cov = coverage(
        cells, periods, "company_id", SERVICE, "start_date", "end_date", "is_fy_paid",
        keep_unserved=True,
    )
    return cov.select(
        surrogate_key("fy_id", "company_id", SERVICE).alias("company_year_service_id"),
        "fy_id", "company_id", "start_date", "end_date", SERVICE, "is_fy_paid",
    )


def month_grid(financial_years: DataFrame) -> DataFrame:
    """Month cells of every financial year (K3)."""
    return period_grid(financial_years, "month").select(
        "fy_id", "company_id", F.col("start_date").alias("fy_start_date"),
        F.col("end_date").alias("fy_end_date"), "month_start_date", "month_end_date",
    )


def quarter_grid(financial_years: DataFrame) -> DataFrame:
    """Quarter cells of every financial year (K3)."""
    return period_grid(financial_years, "quarter").select(
        "fy_id", "company_id", F.col("start_date").alias("fy_start_date"),
        F.col("end_date").alias("fy_end_date"), "quarter_start_date", "quarter_end_date",
    )


def _paid_cells(years: DataFrame, periods: DataFrame, unit: str, services: Sequence[str]) -> DataFrame:
    """The cells of ``month_grid`` or ``quarter_grid`` with their flags; the grid is laid out
    within ``coverage``, where the years have met their periods."""
    cs, ce, flag = f"{unit}_start_date", f"{unit}_end_date", f"is_{unit}_paid"
    rows = years.select(
        "fy_id", "company_id", F.col("start_date").alias("fy_start_date"),
        F.col("end_date").alias("fy_end_date"),
    )
    cov = coverage(
        rows, periods, "company_id", SERVICE, cs, ce, flag,
        services=services, keep_unserved=False, grid=(unit, "fy_start_date", "fy_end_date"),
    )
    return cov.select(
        surrogate_key("fy_id", "company_id", SERVICE, cs).alias(
            f"company_year_{unit}_service_id"
        ),
        "fy_id", "company_id", "fy_start_date", "fy_end_date", SERVICE, cs, ce, flag,
    )


def paid_months(
    financial_years: DataFrame, periods: DataFrame, services: Sequence[str] = MONTH_SERVICES
) -> DataFrame:
    """Per month of each financial year and reported service: fully paid?"""
    return _paid_cells(financial_years, periods, "month", services)


def paid_quarters(
    financial_years: DataFrame, periods: DataFrame, services: Sequence[str] = QUARTER_SERVICES
) -> DataFrame:
    """Per quarter of each financial year and reported service: fully paid?"""
    return _paid_cells(financial_years, periods, "quarter", services)
