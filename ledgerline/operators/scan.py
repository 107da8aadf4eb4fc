"""Running sums and neighbours along an order, for keys of any size.

A window function holds a key's rows in one task.  That is fine for the days of a company;
for timestamps, or a table that is one key, it isn't.  Here the rows are range-partitioned by
(key, order), so a key's rows lie in as many adjacent ranges as they need.  Each (key, range)
is a segment, which a window holds alone; what a segment needs from the others of its key, the
sum of those before or its neighbours' outermost rows, is a table with one row per segment,
scanned by a window that sees at most one row per range and joined back.

The ranges are stored once, as the result needs them twice and their bounds must be the same
both times.  The order should be total within a key: rows that tie stand next to each other,
in no particular order among themselves, as in a window.  NULLs come first, and a NULL key is
a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.tables import materialize

_PART, _AT = "__ll_part", "__ll_at"


def segments(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``df`` stored in ranges of (keys, order), with the range's number and the row's place
    in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, *order_by]
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id() % F.lit(1 << 33)
    return materialize(dealt.withColumn(_PART, F.spark_partition_id()).withColumn(_AT, place), "segments")


def _with_facts(rows: DataFrame, keys: Sequence[str], facts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per segment."""
    names = {c: f"__ll_f_{c}" for c in [*keys, _PART]}
    facts = facts.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return rows.join(facts, same, "left").drop(*names.values())


def running_sum(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, alias: str
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order_by ROWS UNBOUNDED PRECEDING)``.
    ``keys`` may be empty: then the whole table is one key."""
    rows = segments(df, keys, order_by)
    local = Window.partitionBy(_PART, *keys).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(_PART, *keys).agg(F.sum(value).alias("__ll_sum"))
    carries = sums.withColumn("__ll_carry", F.sum("__ll_sum").over(before)).drop("__ll_sum")
    own = F.sum(value).over(local)
    out = _with_facts(rows.withColumn(alias, own), keys, carries)
    both = F.when(F.col(alias).isNull(), F.col("__ll_carry")).otherwise(F.col(alias) + F.coalesce("__ll_carry", F.lit(0)))
    return out.withColumn(alias, both).drop(_PART, _AT, "__ll_carry")


def neighbours(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, lag: str, lead: str
) -> DataFrame:
    """``LAG(value)`` and ``LEAD(value)`` over (keys, order): the values of the rows before and
    after, NULL at a key's ends."""
    rows = segments(df, keys, order_by)
    local = Window.partitionBy(_PART, *keys).orderBy(_AT)
    parts = Window.partitionBy(*keys).orderBy(_PART)
    held = F.struct(F.col(value).alias("v"))  # tells a NULL value from no row
    ends = rows.groupBy(_PART, *keys).agg(F.min_by(held, _AT).alias("__ll_first"), F.max_by(held, _AT).alias("__ll_last"))
    ends = ends.select(
        _PART, *keys, F.lag("__ll_last").over(parts).alias("__ll_before"), F.lead("__ll_first").over(parts).alias("__ll_after")
    )

    def across(near: Column, far: str) -> Column:
        return F.coalesce(near, F.col(far))["v"]

    out = rows.withColumn("__ll_lag", F.lag(held).over(local)).withColumn("__ll_lead", F.lead(held).over(local))
    out = _with_facts(out, keys, ends)
    return out.withColumn(lag, across(F.col("__ll_lag"), "__ll_before")).withColumn(lead, across(F.col("__ll_lead"), "__ll_after")).drop(
        _PART, _AT, "__ll_lag", "__ll_lead", "__ll_before", "__ll_after"
    )
