"""Text classification (K10, H-str2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col

# The tag names tested, in the order the first match wins.
TAG_STATUSES = ["mia", "paidStrikeOff", "ndStrikeOff"]


def tag_status(col, statuses: list[str] = TAG_STATUSES) -> Column:
    """First status whose name occurs in the tag text (``LIKE '%name%'``); else NULL."""
    c = to_col(col)
    out = None
    for name in statuses:
        out = (F.when if out is None else out.when)(c.contains(name), F.lit(name))
    return out
