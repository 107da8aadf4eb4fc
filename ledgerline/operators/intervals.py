"""Paid-interval operators: merging (K2), period grids (K3) and coverage (K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col
from ledgerline.functions.dates import month_end_of, quarter_end_of
from ledgerline.operators.joins import BASE_BITS, bucket_class, day_number

def open_counts(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    day: str = "day",
    change: str = "net_change",
    open_col: str = "open_items",
) -> DataFrame:
    """Per key, every day on which the number of open intervals changes: the net
    change and the number open from that day on (W2, the reference's running
    ``SUM(inc)``).

    Event form: every closed interval ``[start, end]`` adds +1 on its first day and -1
    on the day after its last.  Both events come from one pass over the input (a
    generator), and they are summed per ``(key, day)`` before the shuffle: that
    aggregate is combined map-side, so a key holding a third of all intervals reaches
    the exchange as at most one row per distinct day.  The running sum is then one
    window over those few rows.

    Rows without an end are left out by rule, rows ending before they start as errors
    (``rejected_intervals`` counts them).  A NULL start is open: it counts from the NULL
    day, which sorts before every date.  Days whose events cancel out are left out.
    """
    kcols = [F.col(k) for k in keys]
    valid = df.filter(
        F.col(end).isNotNull() & (F.col(start).isNull() | (F.col(start) <= F.col(end)))
    )
    events = valid.select(
        *kcols,
        F.inline(
            F.array(
                F.struct(F.col(start).alias(day), F.lit(1).alias("__ll_inc")),
                F.struct(F.date_add(F.col(end), 1).alias(day), F.lit(-1).alias("__ll_inc")),
            )
        ),
    )
    deltas = (
        events.groupBy(*keys, day)
        .agg(F.sum("__ll_inc").alias(change))
        .filter(F.col(change) != 0)
    )
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return deltas.withColumn(open_col, F.sum(change).over(w))


def rejected_intervals(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Per ``by``: the number of intervals, of those that ``open_counts`` and
    ``merge_intervals`` reject as reversed (an end before the start), and of those without a
    start, whose periods the merge leaves out.  One grouped count, to be stored beside the
    merge."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col(end) < F.col(start)).alias("reversed_items"),
        F.count_if(F.col(start).isNull()).alias("items_without_start"),
    )


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    out_start: str = "start_date",
    out_end: str = "finish_date",
) -> DataFrame:
    """Merge closed date intervals ``[start, end]`` that overlap or touch, per key (K2).

    From ``open_counts``: a period starts on a day where the count of open intervals
    leaves 0 and ends the day before it comes back to 0.  The boundary days alternate
    start, end, start, ... per key, so ``lead`` pairs each start with its end over the
    same partitioning and order (no further shuffle or sort).

    Rows without an end, or ending before they start, take no part.  A NULL start is
    open: it swallows what it overlaps, and the resulting period has no start, so it is
    left out as a whole.  ``rejected_intervals`` counts both.
    """
    kcols = [F.col(k) for k in keys]
    counts = open_counts(df, keys, start, end, "__ll_day", "__ll_delta", "__ll_open")
    is_first = (F.col("__ll_open") - F.col("__ll_delta")) == 0
    is_after_last = F.col("__ll_open") == 0
    w = Window.partitionBy(*keys).orderBy("__ll_day")
    bounds = counts.filter(is_first | is_after_last).withColumn(
        "__ll_next", F.lead("__ll_day").over(w)
    )
    return bounds.filter(is_first & F.col("__ll_day").isNotNull()).select(
        *kcols,
        F.col("__ll_day").alias(out_start),
        F.date_sub(F.col("__ll_next"), 1).alias(out_end),
    )


MONTHS = {"month": 1, "quarter": 3}  # of a cell


def _first(start) -> Column:
    """The first of the month a year starts in, where its cells begin."""
    return F.trunc(to_col(start), "month")


def grid_cells(
    unit: str, start: str, end: str, cell_start: str, cell_end: str, from_day: Column, to_day: Column
) -> Column:
    """The cells of ``period_grid`` that start on ``from_day`` .. ``to_day``, as an array of
    structs; NULL if none does."""
    step, first = MONTHS[unit], _first(start)
    since = F.greatest(first, from_day)
    month = F.when(F.trunc(since, "month") == since, since).otherwise(F.add_months(F.trunc(since, "month"), 1))
    months = (F.year(month) - F.year(first)) * 12 + F.month(month) - F.month(first)
    opening = F.add_months(first, ((months + step - 1) / step).cast("int") * step)
    until = F.least(F.col(end), to_day)
    starts = F.when(
        F.col(end).isNotNull() & (opening <= until),
        F.sequence(opening, until, F.expr(f"INTERVAL {step} MONTH")),
    )
    ender = month_end_of if unit == "month" else quarter_end_of
    return F.transform(starts, lambda s: F.struct(s.alias(cell_start), ender(s, end).alias(cell_end)))


def period_grid(
    years: DataFrame,
    unit: str,
    start: str = "start_date",
    end: str = "end_date",
    cell_start: str | None = None,
    cell_end: str | None = None,
) -> DataFrame:
    """Cells of each financial year: ``unit`` is ``'month'`` or ``'quarter'`` (K3).

    Cells step from the first of the month the year starts in, up to the year's end:
    a year starting mid-month has a first cell starting before it.  Month cells end at
    the month's last day, cut at the year's end; quarter cells end three months later
    less a day (the last quarter may run past the year's end).  A year ending before
    that first day, or with a NULL bound, has no cells.
    """
    cell_start = cell_start or f"{unit}_start_date"
    cell_end = cell_end or f"{unit}_end_date"
    first = _first(start)
    cells = F.when(
        first <= F.col(end),
        F.sequence(first, F.col(end), F.expr(f"INTERVAL {MONTHS[unit]} MONTH")),
    )
    out = years.withColumn(cell_start, F.explode(cells))
    ender = month_end_of if unit == "month" else quarter_end_of
    return out.withColumn(cell_end, ender(cell_start, end))


def coverage(
    cells: DataFrame,
    periods: DataFrame,
    key: str,
    service: str,
    cell_start: str,
    cell_end: str,
    flag: str,
    period_start: str = "start_date",
    period_end: str = "finish_date",
    services: Sequence[str] | None = None,
    keep_unserved: bool = True,
    grid: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Flag, per cell and per service the key has any period for, whether one single
    period covers the whole cell (K4): ``period.start <= cell.start AND cell.end <=
    period.end``.

    Output: the distinct rows of ``cells``, plus ``service`` and ``flag``, one row per cell
    and service.  With ``keep_unserved`` a cell of a key without any period is kept with
    service and flag NULL (the year grain); otherwise it is dropped (month and quarter
    grains, which filter on the service).  ``services`` restricts the services.  A cell
    without a bound is covered by nothing.

    With ``grid``, a unit and the start and end columns of a year, ``cells`` holds years, and
    the cells are those of ``period_grid``.  Years are shuffled, never their cells: these are
    made where the year has met its periods.

    ``periods`` are the disjoint periods of ``merge_intervals``.  They are packed by (key,
    service, bucket of 512 days), so a pack has 256 of them at most, and a cell or year meets
    the packs of the buckets its cells start in.  The few periods too long for such buckets (a
    key and service has no more than one in 20 years) come with the service.  A key with very
    many cells is spread over (key, service, bucket), which AQE can split further.  Rows are
    dealt out by their hash before equal ones are dropped: the task that reads a small file
    of years holds none of them.
    """
    per = periods if services is None else periods.filter(F.col(service).isin(list(services)))
    bits, size = BASE_BITS["year"], bucket_class(period_start, period_end, "year")
    period = F.struct(F.col(period_start).alias("s"), F.col(period_end).alias("e"))
    served = per.groupBy(key, service).agg(F.collect_list(F.when(size > bits, period)).alias("__ll_long"))
    touched = F.sequence(*[F.shiftright(day_number(c), bits) for c in (period_start, period_end)])
    packs = per.filter(size == bits).select(
        F.col(key).alias("__ll_k"), F.col(service).alias("__ll_s"), F.explode(touched).alias("__ll_pb"), period.alias("__ll_p"),
    ).groupBy("__ll_k", "__ll_s", "__ll_pb").agg(F.collect_list("__ll_p").alias("__ll_short"))

    rows = cells.repartition(*cells.columns).distinct().join(served, key, "left" if keep_unserved else "inner")
    if grid is None:
        rows = rows.withColumn("__ll_b", F.shiftright(day_number(cell_start), bits))
    else:
        unit, start, end = grid
        spanned = F.sequence(*[F.shiftright(day_number(c), bits) for c in (_first(start), end)])
        rows = rows.withColumn("__ll_b", F.explode(F.when(_first(start) <= F.col(end), spanned)))
    # listed services are never NULL: by plain equality the packs lie as they were grouped
    same = F.col(service).eqNullSafe(F.col("__ll_s")) if services is None else F.col(service) == F.col("__ll_s")
    met = rows.join(
        packs,
        (F.col(key) == F.col("__ll_k")) & same & (F.col("__ll_b") == F.col("__ll_pb")),
        "left",
    )

    def covered(s: Column, e: Column) -> Column:
        hits = [F.exists(ps, lambda p: (p["s"] <= s) & (e <= p["e"])) for ps in ("__ll_short", "__ll_long")]
        return F.when(F.col("__ll_long").isNotNull(), F.coalesce(hits[0] | hits[1], F.lit(False)))

    kept = [F.col(c) for c in dict.fromkeys([*cells.columns, service])]
    if grid is None:
        return met.select(*kept, covered(F.col(cell_start), F.col(cell_end)).alias(flag))
    opening = F.shiftleft("__ll_b", bits)
    own = grid_cells(
        unit, start, end, cell_start, cell_end, F.date_from_unix_date(opening), F.date_from_unix_date(opening + (2**bits - 1))
    )
    flagged = F.transform(own, lambda c: c.withField(flag, covered(c[cell_start], c[cell_end])))
    return met.select(*kept, F.inline(flagged))
