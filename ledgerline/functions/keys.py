"""Surrogate keys and row links (H-str1, H-str4, B8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col


def surrogate_key(*cols) -> Column:
    """md5 of the listed columns as text, joined by ``-``, NULL taking part as ``''``.

    Equal listed values give equal keys, and the digest is the same in any engine that
    renders integers and ISO dates alike (Spark and DuckDB do).
    """
    parts = [F.coalesce(to_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def link(prefix: str, col) -> Column:
    """``prefix || id``: a link to the row in an operator's tool; NULL id gives NULL."""
    return F.concat(F.lit(prefix), to_col(col).cast("string"))
