"""Latest row per key.

``latest_by`` and ``distinct_on`` are a ``row_number`` filter over a window.  Spark plans a
filter ``row_number <= 1`` as a partial ``WindowGroupLimit`` *before* the shuffle, so every map task
forwards at most its local winner(s) per key: a key holding a third of all rows costs one
row per map task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_RN = "__ll_rn"


def _items(items) -> list:
    if items is None:
        return []
    if isinstance(items, (str, Column)):
        return [items]
    return list(items)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by,
    tiebreak=None,
) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (ties by ``tiebreak``,
    also descending).  Rows with a NULL order come last but are returned when a key has
    nothing else, unlike ``max_by``.  All values come from the same row.

    ``order_by`` and ``tiebreak`` take column names (sorted descending, NULLs last) or
    ready sort Columns such as ``F.col('x').asc()``.
    """
    order = [
        F.col(c).desc_nulls_last() if isinstance(c, str) else c
        for c in _items(order_by) + _items(tiebreak)
    ]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``SELECT DISTINCT ON (keys) ... ORDER BY keys, order``: the first row per key in
    the given order.  Pass sort Columns with explicit NULL placement, e.g.
    ``F.col('t').desc_nulls_first()`` for PostgreSQL's ``DESC``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    values: Sequence[str],
    max_alias: str | None = None,
) -> DataFrame:
    """Every distinct ``values`` combination found at the key's greatest ``order_col``,
    ties kept (the max + self-join + DISTINCT pattern, J12).

    Two phases: the maximum per key is combined map-side, then the rows that reach it are
    joined back and made distinct.  No task needs the rows of a key together, so a key of
    which a third of all rows are tied is split like any skewed join, and the distinct spreads
    its rows by all columns.  Rows with a NULL order never equal the maximum and are dropped;
    a NULL key is a key.
    """
    rows = df.filter(F.col(order_col).isNotNull()).select(*keys, *values, order_col)
    names = [f"__ll_k{i}" for i in range(len(keys))]
    top = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.max(order_col).alias("__ll_top"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    out = rows.join(top, [*same, F.col(order_col) == F.col("__ll_top")], "left_semi").distinct()
    if max_alias:
        out = out.withColumnRenamed(order_col, max_alias)
    return out
