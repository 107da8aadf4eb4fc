"""DataFrame -> DataFrame building blocks."""

from ledgerline.operators.intervals import (
    coverage,
    merge_intervals,
    open_counts,
    period_grid,
    rejected_intervals,
)
from ledgerline.operators.joins import (
    anti_join,
    interval_join,
    longest_days,
    not_in,
    not_in_rows,
    semi_join,
    with_match_flag,
)
from ledgerline.operators.latest import distinct_on, latest_by, latest_rows
from ledgerline.operators.quality import (
    duplicate_groups,
    duplicate_rate,
    duplicate_rows,
    with_key_count,
)
from ledgerline.operators.scan import neighbours, running_sum
from ledgerline.operators.sets import repeat_rows, union_all, union_distinct

__all__ = [
    "anti_join",
    "coverage",
    "distinct_on",
    "duplicate_groups",
    "duplicate_rate",
    "duplicate_rows",
    "interval_join",
    "latest_by",
    "latest_rows",
    "longest_days",
    "merge_intervals",
    "neighbours",
    "not_in",
    "not_in_rows",
    "open_counts",
    "period_grid",
    "rejected_intervals",
    "repeat_rows",
    "running_sum",
    "semi_join",
    "union_all",
    "union_distinct",
    "with_key_count",
    "with_match_flag",
]
