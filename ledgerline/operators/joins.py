"""Join recipes the reference relies on.

None of them forces a physical strategy.  They are equi-joins, and AQE picks the
strategy at run time: it broadcasts a side only once that side's measured size is under
the threshold, and otherwise keeps a sort-merge join whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col


def with_match_flag(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], flag: str
) -> DataFrame:
    """Left join that also records whether a right row matched (``right.key IS NOT NULL``
    after the join, B6).  ``right`` should hold one row per key."""
    flagged = right.withColumn(flag, F.lit(True))
    return left.join(flagged, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``WHERE k IN (SELECT k FROM right)`` (J5): NULL keys never match."""
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``LEFT JOIN right ... WHERE right.k IS NULL`` (J7).  Left rows with a NULL key are
    kept, as in the outer-join form."""
    return left.join(right, on, "left_anti")


def not_in_rows(
    left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]
) -> DataFrame:
    """``WHERE (a, b, ...) NOT IN (SELECT x, y, ... FROM right)`` with SQL's NULL rules.

    A comparison of two rows is false only if some column differs with both values known.
    So a left row stays if it differs like that from *every* right row: it goes if it agrees
    with one wherever both have a value, and an all-NULL row agrees with everything.

    Right rows are told apart by their pattern of known columns.  For each pattern there is
    one anti-join on those columns, with NULL for the columns that the left row lacks:
    the distinct right rows are repeated once for each set of known columns that a left row
    can share with the pattern.  A left row that shares no known column with some pattern
    goes whatever its values; which patterns there are is one scalar subquery.  Patterns
    without rows cost nothing at run time: AQE drops their joins.  At most six columns.
    """
    n = len(left_cols)
    if not 1 <= n == len(right_cols) <= 6:
        raise ValueError("not_in_rows compares one to six columns of each side")
    values = [f"__ll_v{i}" for i in range(n)]

    def known(cols: Sequence[Column]) -> Column:
        bits = [F.when(c.isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols)]
        return sum(bits[1:], bits[0])

    keys = right.select(*[F.col(c).alias(v) for c, v in zip(right_cols, values)]).distinct()
    keys = keys.withColumn("__ll_known", known([F.col(v) for v in values]))
    present = keys.agg(F.coalesce(F.bit_or(F.expr("shiftleft(1L, __ll_known)")), F.lit(0).cast("long"))).scalar()
    out = left.withColumn("__ll_known", known([F.col(c) for c in left_cols]))
    shares_none = F.lit(False)
    for pattern in range(2**n):
        is_there = present.bitwiseAND(F.lit(1 << pattern).cast("long")) != 0
        shares_none = shares_none | (is_there & (F.col("__ll_known").bitwiseAND(F.lit(pattern)) == 0))
    out = out.filter(~shares_none)
    for pattern in range(1, 2**n):
        of = [i for i in range(n) if pattern >> i & 1]
        subsets = [m for m in range(1, 2**n) if m & ~pattern == 0]
        some = keys.filter(F.col("__ll_known") == pattern).withColumn("__ll_shared", F.explode(F.array(*map(F.lit, subsets))))
        some = some.select(
            "__ll_shared",
            *[F.when(F.col("__ll_shared").bitwiseAND(F.lit(1 << i)) != 0, F.col(values[i])).alias(values[i]) for i in of],
        ).distinct()
        same = [F.col("__ll_known").bitwiseAND(F.lit(pattern)) == F.col("__ll_shared")]
        same += [F.col(left_cols[i]).eqNullSafe(F.col(values[i])) for i in of]
        out = out.join(some, same, "left_anti")
    return out.drop("__ll_known")


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """``WHERE left_col NOT IN (SELECT right_col FROM right)`` with SQL's NULL rules.

    - ``right`` empty: every left row is kept, NULL keys included;
    - ``right`` holds a NULL: no row is kept;
    - otherwise: rows whose key is NULL or found in ``right`` are dropped.

    Spark plans ``NOT IN`` as a null-aware anti join, which must broadcast the subquery or
    falls back to a nested-loop join.  Here the two NULL facts (is ``right`` empty, does
    it hold a NULL) come from one scalar subquery, a global aggregate evaluated once, and
    the membership test is a plain ``left_anti`` equi-join against the non-NULL keys,
    which scales like any other shuffle join (and which AQE broadcasts only when the key
    set turns out small).
    """
    # Both the NULL facts and the anti join read one distinct set of the right keys (NULL
    # kept as one value), so the right side's source is evaluated once and its exchange
    # is shared.  0: right is empty, 1: right holds a NULL, 2: neither.
    distinct_keys = right.select(F.col(right_col).alias("__ll_k")).distinct()
    state = distinct_keys.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(0))
        .when(F.count_if(F.col("__ll_k").isNull()) > 0, F.lit(1))
        .otherwise(F.lit(2))
    ).scalar()
    keep = (state == 0) | ((state == 2) & F.col(left_col).isNotNull())
    keys = distinct_keys.filter(F.col("__ll_k").isNotNull())
    return (
        left.filter(keep)
        .join(keys, F.col(left_col) == F.col("__ll_k"), "left_anti")
    )


# Buckets of interval_join: the smallest are 2 ** BASE_BITS[unit] days, each class above has
# 2 ** CLASS_BITS times longer ones, and the largest class takes intervals of any length.
BASE_BITS = {"year": 9, "quarter": 7, "month": 5}
CLASS_BITS = 4
DAY_BITS = 22  # of a day number: 10,000 years


def _classes(unit: str) -> list[int]:
    """The bucket sizes of a unit, as powers of two."""
    return list(range(BASE_BITS[unit], DAY_BITS - 1, CLASS_BITS))


def day_number(col) -> Column:
    return F.unix_date(to_col(col).cast("date"))


def bucket_class(start, end, unit: str) -> Column:
    """The class of a closed interval: the smallest whose buckets it touches at most
    2 ** CLASS_BITS of.  NULL for an interval that is empty or lacks a bound."""
    s, e = day_number(start), day_number(end)
    *short, longest = _classes(unit)
    found = F.lit(longest)
    for bits in reversed(short):
        found = F.when(F.shiftright(e, bits) - F.shiftright(s, bits) < 2**CLASS_BITS, F.lit(bits)).otherwise(found)
    return F.when(to_col(start) <= to_col(end), found)


def longest_days(intervals: DataFrame, start: str, end: str) -> int:
    """Days of the longest interval: one small job, for intervals that are stored."""
    return intervals.agg(F.max(day_number(end) - day_number(start) + 1)).first()[0] or 0


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    how: str = "left",
    unit: str = "year",
    longest: int | None = None,
) -> DataFrame:
    """Join each point to the intervals of its key that contain it (J9):
    ``key = key AND point BETWEEN start AND end``.

    A join on the key alone would pair every point with every interval of its key
    before the range test.  Here the join key is ``(key, bucket)``, and a point meets only
    the intervals of its own bucket.  Buckets come in a few sizes, each 16 times the one
    before (``unit`` names the smallest: a year's is 512 days).  An interval is expanded at
    the smallest size of which it touches 16 buckets at most, so one of a day has one row, one
    of a year two, and one of 8,000 years 24.  Points are shuffled once, by the smallest
    buckets, where usual intervals lie.  Longer intervals are brought there: the distinct
    (key, smallest bucket) that hold a point are looked up in the longer sizes, up to the
    longest that any interval needs (a scalar subquery), and a long interval gets a row for each
    that it reaches.  Only buckets with points count, so these rows are no more than the
    matches and the two ends.  Where the days of the ``longest`` interval are known
    (``longest_days`` of a stored table), the lookups of sizes beyond it are not even planned.

    The columns of ``points`` are the fields of a struct ``p``, those of ``intervals`` of a
    struct ``i``: ``p.<name>`` and ``i.<name>``.  ``how`` is ``inner`` or ``left``: intervals
    without a bound have no bucket, so a join that must keep unmatched intervals would lose them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join is inner or left, not {how!r}")
    smallest, *longer = _classes(unit)
    p = points.select(F.struct(*points.columns).alias("p"), F.shiftright(day_number(point), smallest).alias("__ll_pb"))
    size = bucket_class(start, end, unit)
    i = intervals.select(F.struct(*intervals.columns).alias("i"), size.alias("__ll_size"), day_number(start).alias("__ll_s"), day_number(end).alias("__ll_e"))
    spread = F.expr("explode(sequence(shiftright(__ll_s, __ll_size), shiftright(__ll_e, __ll_size)))")
    met = i.filter(F.col("__ll_size") == smallest).select("i", spread.alias("__ll_ib"))
    # an interval of n days touches at most n / size + 2 buckets
    needed = [bits for bits in longer if longest is None or (longest >> (bits - CLASS_BITS)) + 2 > 2**CLASS_BITS]
    if needed:
        top = intervals.agg(F.max(size)).scalar() if longest is None else F.lit(needed[-1])
        names = [f"__ll_k{n}" for n in range(len(left_keys))]
        held = p.filter(top > smallest).select(*[F.col(f"p.{lk}").alias(n) for lk, n in zip(left_keys, names)], "__ll_pb").distinct()
        sized = held.select("*", F.explode(F.array(*map(F.lit, needed))).alias("__ll_bits")).filter(F.col("__ll_bits") <= top).withColumn(
            "__ll_wide", F.expr(f"shiftright(__ll_pb, __ll_bits - {smallest})")
        )
        rare = i.filter(F.col("__ll_size") > smallest).select("*", spread.alias("__ll_ib"))
        reached = sized.join(
            rare,
            [
                *[F.col(n) == F.col(f"i.{rk}") for n, rk in zip(names, right_keys)],
                F.col("__ll_bits") == F.col("__ll_size"),
                F.col("__ll_wide") == F.col("__ll_ib"),
                F.col("__ll_pb").between(F.shiftright("__ll_s", smallest), F.shiftright("__ll_e", smallest)),
            ],
        )
        met = met.unionByName(reached.select("i", F.col("__ll_pb").alias("__ll_ib")))
    keys = [F.col(f"p.{lk}") == F.col(f"i.{rk}") for lk, rk in zip(left_keys, right_keys)]
    within = F.col(f"p.{point}").between(F.col(f"i.{start}"), F.col(f"i.{end}"))
    return p.join(met, [*keys, F.col("__ll_pb") == F.col("__ll_ib"), within], how).select("p", "i")
