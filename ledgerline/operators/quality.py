"""Duplicate audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_groups(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key combinations that occur more than once, with their row count (G5 + P17).

    A plain grouped count: partial counts are combined map-side before the shuffle."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )


def duplicate_rate(
    groups: DataFrame, by: Sequence[str], count_col: str, rate_col: str
) -> DataFrame:
    """Mean number of surplus copies per duplicated group: ``SUM(n - 1) / COUNT(*)``
    per ``by`` (G8, G9, G15)."""
    return groups.groupBy(*by).agg(
        (F.sum(F.col(count_col) - 1) / F.count(F.lit(1))).alias(rate_col)
    )


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose ``key`` value occurs more than once (``QUALIFY COUNT(*) OVER
    (PARTITION BY key) > 1``, K11).

    A window count would hold each key's rows in one task.  Instead the counts are a
    map-side combined aggregate, and the rows are kept by a semi-join with the
    repeated keys, which AQE can split when one key is hot.  NULL keys form one group
    in the window form, so they are matched null-safely.
    """
    repeated = (
        df.groupBy(F.col(key).alias("__ll_k"))
        .agg(F.count(F.lit(1)).alias("__ll_n"))
        .filter(F.col("__ll_n") > 1)
        .select("__ll_k")
    )
    return df.join(repeated, F.col(key).eqNullSafe(F.col("__ll_k")), "left_semi")


def with_key_count(df: DataFrame, key: str, count_col: str) -> DataFrame:
    """Every row with the number of rows sharing its ``key`` (``COUNT(*) OVER (PARTITION
    BY key)``, W6), NULL keys counted as one group.  Counted by a map-side combined
    aggregate and joined back, instead of a window that holds each key in one task."""
    counts = df.groupBy(F.col(key).alias("__ll_k")).agg(F.count(F.lit(1)).alias(count_col))
    joined = df.join(counts, F.col(key).eqNullSafe(F.col("__ll_k")), "inner")
    return joined.drop("__ll_k")
