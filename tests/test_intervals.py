"""merge_intervals, period_grid and coverage on hand-made inputs and against brute force."""

import datetime as dt
import random

import pytest

from ledgerline.operators.intervals import (
    coverage,
    merge_intervals,
    period_grid,
    rejected_intervals,
)

D0 = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def merged(spark, rows, keys=("k",)):
    df = spark.createDataFrame(
        [(*key, day(s), day(e)) for (*key, s, e) in rows],
        ", ".join(f"{k} string" for k in keys) + ", s date, e date",
    )
    out = merge_intervals(df, list(keys), "s", "e").collect()
    return sorted(
        (tuple(r[k] for k in keys), (r.start_date - D0).days, (r.finish_date - D0).days)
        for r in out
    )


CASES = [
    ([(1, 5)], [(1, 5)]),
    ([(1, 5), (3, 9)], [(1, 9)]),
    ([(1, 5), (6, 9)], [(1, 9)]),
    ([(1, 5), (7, 9)], [(1, 5), (7, 9)]),
    ([(1, 9), (3, 4)], [(1, 9)]),
    ([(1, 5), (1, 5)], [(1, 5)]),
    ([(1, 1)], [(1, 1)]),
    ([(None, 9), (3, 12), (20, 22)], [(20, 22)]),
    ([(5, 4)], []),
    ([(5, None)], []),
]


@pytest.mark.parametrize("rows,expected", CASES)
def test_merge_cases(spark, rows, expected):
    got = merged(spark, [("a", s, e) for s, e in rows])
    assert [(s, e) for _, s, e in got] == expected


def test_merge_partitions_by_key(spark):
    rows = [("a", "x", 1, 5), ("b", "x", 1, 5), ("a", "y", 1, 5)]
    got = merged(spark, rows, keys=("c", "svc"))
    assert got == [(("a", "x"), 1, 5), (("a", "y"), 1, 5), (("b", "x"), 1, 5)]


def brute_merge(intervals):
    days = set()
    for s, e in intervals:
        if s is not None and e is not None and s <= e:
            days.update(range(s, e + 1))
    out, run = [], None
    for d in sorted(days):
        if run and d == run[1] + 1:
            run[1] = d
        else:
            if run:
                out.append(tuple(run))
            run = [d, d]
    if run:
        out.append(tuple(run))
    return out


def test_merge_matches_brute_force(spark):
    rng = random.Random(7)
    rows, expected = [], []
    for key in range(60):
        ivs = []
        for _ in range(rng.randint(1, 12)):
            s = rng.randint(0, 80)
            ivs.append((s, s + rng.randint(-2, 15)))
        rows += [(f"k{key}", s, e) for s, e in ivs]
        expected += [((f"k{key}",), s, e) for s, e in brute_merge(ivs)]
    assert merged(spark, rows) == sorted(expected)


def grid(spark, start, end, unit):
    df = spark.createDataFrame([(start, end)], "start_date date, end_date date")
    out = period_grid(df, unit).collect()
    return [(r[f"{unit}_start_date"], r[f"{unit}_end_date"]) for r in out]


def d(s):
    return dt.date.fromisoformat(s)


def test_month_grid_starts_on_first_and_cuts_at_year_end(spark):
    assert grid(spark, d("2023-01-15"), d("2023-03-20"), "month") == [
        (d("2023-01-01"), d("2023-01-31")),
        (d("2023-02-01"), d("2023-02-28")),
        (d("2023-03-01"), d("2023-03-20")),
    ]


def test_quarter_grid_last_quarter_runs_past_year_end(spark):
    assert grid(spark, d("2023-01-15"), d("2023-08-20"), "quarter") == [
        (d("2023-01-01"), d("2023-03-31")),
        (d("2023-04-01"), d("2023-06-30")),
        (d("2023-07-01"), d("2023-09-30")),
    ]
    assert grid(spark, d("2023-01-15"), d("2023-04-01"), "quarter") == [
        (d("2023-01-01"), d("2023-03-31")),
        (d("2023-04-01"), d("2023-04-01")),
    ]


def test_grid_reversed_or_null_year_has_no_cells(spark):
    assert grid(spark, d("2023-05-01"), d("2023-01-01"), "month") == []
    assert grid(spark, None, d("2023-01-01"), "quarter") == []


def run_coverage(spark, cells, periods, keep_unserved=True, services=None):
    c = spark.createDataFrame(
        [(k, cid, day(s), day(e)) for k, cid, s, e in cells],
        "k string, cell string, cs date, ce date",
    )
    p = spark.createDataFrame(
        [(k, svc, day(s), day(e)) for k, svc, s, e in periods],
        "k string, svc string, start_date date, finish_date date",
    )
    out = coverage(c, p, "k", "svc", "cs", "ce", "paid", services=services,
                   keep_unserved=keep_unserved)
    return sorted(((r.cell, r.svc, r.paid) for r in out.collect()), key=repr)


def test_coverage_cases(spark):
    cell = [("c", "x", 1, 10)]
    assert run_coverage(spark, cell, [("c", "a", 1, 10)]) == [("x", "a", True)]
    assert run_coverage(spark, cell, [("c", "a", 2, 10)]) == [("x", "a", False)]
    assert run_coverage(spark, cell, [("c", "a", 1, 5), ("c", "a", 6, 10)]) == [("x", "a", False)]
    assert run_coverage(spark, cell, [("c", "a", 50, 60)]) == [("x", "a", False)]
    assert run_coverage(spark, cell, [("z", "a", 1, 10)]) == [("x", None, None)]
    assert run_coverage(spark, cell, [("z", "a", 1, 10)], keep_unserved=False) == []
    both = [("c", "a", 0, 20), ("c", "b", 0, 20)]
    assert run_coverage(spark, cell, both, services=["a"], keep_unserved=False) == [
        ("x", "a", True)
    ]


def test_coverage_matches_pairwise_definition(spark):
    rng = random.Random(11)
    cells, periods = [], []
    for k in range(25):
        for i in range(rng.randint(0, 6)):
            s = rng.randint(0, 100)
            cells.append((f"k{k}", f"k{k}-{i}", s, s + rng.randint(0, 30)))
        for svc in "ab":  # disjoint, as merged periods are
            s = 0
            for _ in range(rng.randint(0, 4)):
                s += rng.randint(0, 30)
                e = s + rng.randint(0, 30)
                periods.append((f"k{k}", svc, s, e))
                s = e + 2
    expected = []
    for k, cid, cs, ce in cells:
        svcs = sorted({svc for pk, svc, _, _ in periods if pk == k})
        if not svcs:
            expected.append((cid, None, None))
        for svc in svcs:
            hit = any(pk == k and ps == svc and s <= cs and ce <= e
                      for pk, ps, s, e in periods)
            expected.append((cid, svc, hit))
    assert run_coverage(spark, cells, periods) == sorted(expected, key=repr)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

interval = st.tuples(st.integers(0, 60), st.integers(-3, 20)).map(lambda t: (t[0], t[0] + t[1]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.lists(st.lists(interval, min_size=1, max_size=10), min_size=1, max_size=4))
def test_merge_property(spark, groups):
    rows = [(f"k{g}", s, e) for g, ivs in enumerate(groups) for s, e in ivs]
    got = merged(spark, rows)
    for g, ivs in enumerate(groups):
        mine = [(s, e) for (k,), s, e in got if k == f"k{g}"]
        assert mine == brute_merge(ivs)
        # disjoint and not touching, covering exactly the input's days
        assert all(b[0] > a[1] + 1 for a, b in zip(mine, mine[1:]))
        covered = {d for s, e in mine for d in range(s, e + 1)}
        assert covered == {d for s, e in ivs if s <= e for d in range(s, e + 1)}


def test_rejected_intervals_are_counted(spark):
    rows = [("a", day(5), day(4)), ("a", day(1), day(3)), ("a", None, day(2)), ("b", day(7), None)]
    df = spark.createDataFrame(rows, "k string, s date, e date")
    got = sorted(map(tuple, rejected_intervals(df, ["k"], "s", "e").collect()))
    assert got == [("a", 3, 1, 1), ("b", 1, 0, 0)]


def test_the_first_day_of_the_calendar_is_a_date_like_others(spark):
    rows = [("a", dt.date(1, 1, 1), dt.date(1, 1, 9)), ("b", None, dt.date(1, 1, 9))]
    df = spark.createDataFrame(rows, "k string, s date, e date")
    got = [tuple(r) for r in merge_intervals(df, ["k"], "s", "e").collect()]
    assert got == [("a", dt.date(1, 1, 1), dt.date(1, 1, 9))]


def test_equal_cells_are_one(spark):
    cell = [("c", "x", 1, 10)] * 3
    assert run_coverage(spark, cell, [("c", "a", 1, 10)]) == [("x", "a", True)]


def test_a_year_far_off_costs_no_rows(spark):
    far = spark.createDataFrame([("c", "x", dt.date(9999, 1, 1), dt.date(9999, 12, 31))], "k string, cell string, cs date, ce date")
    p = spark.createDataFrame([("c", "a", day(1), day(9))], "k string, svc string, start_date date, finish_date date")
    out = coverage(far, p, "k", "svc", "cs", "ce", "paid")
    assert [(r.svc, r.paid) for r in out.collect()] == [("a", False)]


def test_cells_of_years_are_those_of_the_grid(spark):
    """Odd years against the cells of ``period_grid``, each with every period."""
    rng = random.Random(5)
    bounds = [("2023-01-15", "2024-01-14"), ("2023-03-01", "2023-02-27"), ("2023-03-20", "2023-03-05"), (None, "2024-01-01"), ("2024-01-01", None),
              ("0001-01-01", "0001-12-31"), ("9998-07-31", "9999-12-31"), ("1950-05-17", "2050-02-02"), ("1969-11-30", "1970-02-28")]
    years = [(k, i, a and d(a), b and d(b)) for i, (a, b) in enumerate(bounds) for k in ("x", "y", "z", None)]
    periods = [("x", "a", d("0001-01-01"), d("2023-06-30")), ("x", "b", d("2000-01-01"), d("2023-02-28")), ("x", "b", d("9000-01-01"), d("9999-12-31")), ("z", "c", d("1700-01-01"), d("1700-01-02"))]
    at = d("1949-01-01")
    for _ in range(300):  # many in a bucket
        end = at + dt.timedelta(days=rng.randint(0, 200))
        periods.append(("y", "a", at, end))
        at = end + dt.timedelta(days=rng.randint(2, 9))
    y = spark.createDataFrame(years * 2, "k string, fy int, ys date, ye date")
    p = spark.createDataFrame(periods, "k string, svc string, start_date date, finish_date date")
    for unit in ("month", "quarter"):
        cells = [(r.k, r.fy, r.cs, r.ce) for r in period_grid(y.distinct(), unit, "ys", "ye", "cs", "ce").collect()]
        want = {
            (k, fy, cs, svc, any((pk, ps) == (k, svc) and s <= cs and ce <= e for pk, ps, s, e in periods))
            for k, fy, cs, ce in cells for svc in {ps for pk, ps, _, _ in periods if pk == k}
        }
        got = coverage(y, p, "k", "svc", "cs", "ce", "paid", keep_unserved=False, grid=(unit, "ys", "ye")).collect()
        assert len(got) == len(want) and {(r.k, r.fy, r.cs, r.svc, r.paid) for r in got} == want
        assert {(r.fy, r.cs, r.ce) for r in got} == {(fy, cs, ce) for k, fy, cs, ce in cells if k}
