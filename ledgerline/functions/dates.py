"""Date helpers (H-dt1..H-dt10, P13, P14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col


def as_date(value) -> Column:
    """A date literal or a column converted to a date (``DATE(ts)``, UTC session)."""
    if isinstance(value, (dt.date, str)):
        return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))
    return F.to_date(to_col(value))


def active_at(start, end, as_of) -> Column:
    """Half-open interval contains ``as_of``: ``start <= as_of AND end > as_of``."""
    day = as_date(as_of) if isinstance(as_of, (dt.date, str)) else to_col(as_of)
    return (to_col(start) <= day) & (to_col(end) > day)


def month_end_of(cell_start, year_end) -> Column:
    """Last day of the cell's month, cut at the year's end."""
    last = F.last_day(to_col(cell_start))
    return F.when(last < to_col(year_end), last).otherwise(to_col(year_end))


def quarter_end_of(cell_start, year_end) -> Column:
    """Three months from the cell's start less a day while the cell starts before the
    year's end, else the year's end (so a last quarter may run past the year)."""
    s = to_col(cell_start)
    return F.when(s < to_col(year_end), F.date_sub(F.add_months(s, 3), 1)).otherwise(
        to_col(year_end)
    )
