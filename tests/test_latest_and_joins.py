"""latest_by / distinct_on / latest_rows, not_in, interval_join, with_match_flag."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators.joins import anti_join, interval_join, not_in, with_match_flag
from ledgerline.operators.latest import distinct_on, latest_by, latest_rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
SCHEMA = "k int, t date, v string, tb int"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_latest_by(spark):
    cases = [
        ([(1, D1, "a", 1), (1, D2, "b", 2)], [(1, "b")]),
        ([(1, D2, None, 1), (1, D1, "a", 2)], [(1, None)]),
        ([(1, None, "a", 1), (1, D1, "b", 2)], [(1, "b")]),
        ([(1, None, "a", 1)], [(1, "a")]),
        ([(1, D1, "a", 1), (1, D1, "b", 2)], [(1, "b")]),
    ]
    for data, expected in cases:
        df = spark.createDataFrame(data, SCHEMA)
        assert rows(latest_by(df, ["k"], "t", ["tb"]), "k", "v") == expected


def test_distinct_on_nulls_first_when_descending(spark):
    df = spark.createDataFrame([(1, None, "a", 1), (1, D1, "b", 2)], SCHEMA)
    out = distinct_on(df, ["k"], [F.col("t").desc_nulls_first()])
    assert rows(out, "k", "v") == [(1, "a")]


def test_latest_rows_keeps_ties(spark):
    df = spark.createDataFrame(
        [(1, D1, "a", 1), (1, D1, "b", 2), (1, D1, "b", 3), (1, None, "z", 4), (2, None, "q", 5)],
        SCHEMA,
    )
    out = latest_rows(df, ["k"], "t", ["v"], "max_t")
    assert rows(out, "k", "v", "max_t") == [(1, "a", D1), (1, "b", D1)]


def keys_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_not_in_null_rules(spark):
    left = keys_df(spark, [1, 2, None])
    cases = [([1, 9], [2]), ([1, None], []), ([], [1, 2, None])]
    for right_vals, expected in cases:
        right = keys_df(spark, right_vals).withColumnRenamed("x", "y")
        got = [r.x for r in not_in(left, right, "x", "y").collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_not_in_matches_sql(spark):
    left = keys_df(spark, [1, 2, None, 4])
    right = keys_df(spark, [4, 5]).withColumnRenamed("x", "y")
    left.createOrReplaceTempView("l_t")
    right.createOrReplaceTempView("r_t")
    sql = spark.sql("SELECT x FROM l_t WHERE x NOT IN (SELECT y FROM r_t)")
    assert sorted(r.x for r in sql.collect()) == sorted(
        r.x for r in not_in(left, right, "x", "y").collect()
    )


def test_anti_join_keeps_null_keys(spark):
    left = keys_df(spark, [1, 2, None])
    right = keys_df(spark, [1, 9])
    assert sorted((r.x for r in anti_join(left, right, "x").collect()), key=repr) == sorted(
        [2, None], key=repr
    )


def test_with_match_flag(spark):
    left = keys_df(spark, [1, 2])
    right = spark.createDataFrame([(1, "a")], "x int, v string")
    out = with_match_flag(left, right, "x", "hit")
    assert rows(out, "x", "hit", "v") == [(1, True, "a"), (2, False, None)]


def test_interval_join_matches_brute_force(spark):
    rng = random.Random(3)
    base = dt.date(2020, 1, 1)
    pts, ivs = [], []
    for i in range(300):
        pts.append((i, rng.randint(0, 9), base + dt.timedelta(days=rng.randint(0, 1500))))
    for j in range(120):
        s = base + dt.timedelta(days=rng.randint(0, 1500))
        ivs.append((j, rng.randint(0, 9), s, s + dt.timedelta(days=rng.randint(-5, 500))))
    p = spark.createDataFrame(pts, "pid int, k int, d date")
    i = spark.createDataFrame(ivs, "iid int, ik int, s date, e date")
    out = interval_join(p, i, ["k"], ["ik"], "d", "s", "e", how="left")
    got = sorted((r.pid, r.iid) for r in out.select("p.pid", "i.iid").collect())
    expected = []
    for pid, k, d in pts:
        hits = [iid for iid, ik, s, e in ivs if ik == k and s <= d <= e]
        expected += [(pid, h) for h in hits] or [(pid, None)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_repeat_rows_splits_large_counts(spark, monkeypatch):
    from ledgerline.operators import sets

    monkeypatch.setattr(sets, "REPEAT_CHUNK", 1000)
    rows = [("a", 1), ("b", 3), ("c", 2501), ("d", 5000), ("none", None), ("zero", 0)]
    out = sets.repeat_rows(spark.createDataFrame(rows, "k string, n long"), "n")
    got = {r.k: r.c for r in out.groupBy("k").count().withColumnRenamed("count", "c").collect()}
    assert got == {"a": 1, "b": 3, "c": 2501, "d": 5000}
    assert out.columns == ["k"]


def test_twenty_million_repeats_are_made_by_many_tasks(spark):
    from ledgerline.operators.sets import repeat_rows

    one = spark.createDataFrame([("a", 20_000_000)], "k string, n long")
    made = repeat_rows(one, "n").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in made) == 20_000_000
    assert len(made) >= 4 and max(r["count"] for r in made) < 10_000_000


def test_interval_join_refuses_what_it_cannot_keep(spark):
    import pytest

    df = spark.createDataFrame([(1, None, None)], "k int, s date, e date")
    with pytest.raises(ValueError):
        interval_join(df, df, ["k"], ["k"], "s", "s", "e", how="right")


def mixed_lengths(spark, n=150):
    """Intervals of a day, a year, decades and 8,000 years; points from year 1 to 9999."""
    rng = random.Random(11)
    first, last = dt.date(1, 1, 1), dt.date(9999, 12, 31)

    def day(mid, spread):
        return dt.date.fromordinal(min(last.toordinal(), max(1, mid.toordinal() + rng.randint(-spread, spread))))

    mid = dt.date(2020, 1, 1)
    pts = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([day(mid, 400), day(mid, 20_000), dt.date(rng.randint(1, 9999), 5, 5), None])) for i in range(n)]
    ivs = []
    for j in range(n):
        s = rng.choice([day(mid, 400), day(mid, 20_000), first, None])
        e = rng.choice([s, s and day(s, 800), s and day(s, 30_000), last, None])
        ivs.append((j, rng.choice([1, 1, 2, 3, 4, None]), s, e))
    return pts, ivs


def brute_interval_join(pts, ivs, how):
    out = []
    for pid, k, d in pts:
        hits = [iid for iid, ik, s, e in ivs if None not in (k, d, s, e) and ik == k and s <= d <= e]
        out += [(pid, h) for h in hits] or ([(pid, None)] if how == "left" else [])
    return sorted(out, key=repr)


def test_interval_join_of_days_and_millennia(spark):
    pts, ivs = mixed_lengths(spark)
    p, i = spark.createDataFrame(pts, "pid int, k int, d date"), spark.createDataFrame(ivs, "iid int, ik int, s date, e date")
    for how in ("left", "inner"):
        for unit in ("year", "month"):
            got = interval_join(p, i, ["k"], ["ik"], "d", "s", "e", how, unit).select("p.pid", "i.iid").collect()
            assert sorted([tuple(r) for r in got], key=repr) == brute_interval_join(pts, ivs, how), (how, unit)


def test_interval_rows_stay_few_whatever_the_length(spark):
    from ledgerline.operators.joins import bucket_class

    days = [(dt.date(2000, 1, 1), dt.date(2000, 1, 1)), (dt.date(2000, 1, 1), dt.date(2000, 12, 31)), (dt.date(1990, 1, 1), dt.date(2020, 1, 1)),
            (dt.date(1, 1, 1), dt.date(9999, 12, 31)), (dt.date(2000, 1, 1), dt.date(9999, 12, 31))]
    for unit in ("year", "quarter", "month"):
        found = spark.createDataFrame(days, "s date, e date").withColumn("bits", bucket_class("s", "e", unit)).withColumn(
            "rows", F.expr("shiftright(unix_date(e), bits) - shiftright(unix_date(s), bits) + 1")
        ).collect()
        assert all(r.rows <= 30 for r in found), unit
        assert found[0].rows == 1


def test_interval_join_without_long_intervals_looks_points_up_once(spark):
    """The lookups of longer sizes are made only when some interval needs them."""
    pts = [(i, 1, dt.date(2020, 1, 1) + dt.timedelta(days=i)) for i in range(500)]
    ivs = [(j, 1, dt.date(2020, 1, 1) + dt.timedelta(days=30 * j), dt.date(2020, 1, 20) + dt.timedelta(days=30 * j)) for j in range(12)]
    p, i = spark.createDataFrame(pts, "pid int, k int, d date"), spark.createDataFrame(ivs, "iid int, ik int, s date, e date")
    got = interval_join(p, i, ["k"], ["ik"], "d", "s", "e").select("p.pid", "i.iid").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_interval_join(pts, ivs, "left")
    long = i.unionByName(spark.createDataFrame([(99, 1, dt.date(1900, 1, 1), dt.date(2021, 1, 1))], i.schema))
    got = interval_join(p, long, ["k"], ["ik"], "d", "s", "e").select("p.pid", "i.iid").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_interval_join(pts, [*ivs, (99, 1, dt.date(1900, 1, 1), dt.date(2021, 1, 1))], "left")
    empty = spark.createDataFrame([], i.schema)
    assert interval_join(p, empty, ["k"], ["ik"], "d", "s", "e").filter("i is null").count() == 500
    assert interval_join(p, empty, ["k"], ["ik"], "d", "s", "e", "inner").count() == 0


def test_not_in_rows_on_all_null_patterns(spark):
    """Three columns, every pattern of NULLs on both sides, against the definition."""
    from itertools import product

    from ledgerline.operators.joins import not_in_rows

    left = [(i, *r) for i, r in enumerate(product([None, 1, 2], repeat=3))]
    l = spark.createDataFrame(left, "id int, a int, b int, c int")
    known = [(1, 1, 1), (2, 2, 1), (1, 2, 2)]
    for pattern in range(8):
        gaps = tuple(v if pattern >> k & 1 else None for k, v in enumerate((2, 1, 2)))
        for right in ([gaps], [*known, gaps], [gaps, gaps, (None, 1, 1)]):
            r = spark.createDataFrame(right, "x int, y int, z int")
            got = sorted(t.id for t in not_in_rows(l, r, ["a", "b", "c"], ["x", "y", "z"]).collect())
            want = [i for i, *row in left if all(any(None not in (u, v) and u != v for u, v in zip(row, other)) for other in right)]
            assert got == want, (pattern, right)
    none = spark.createDataFrame([], "x int, y int, z int")
    assert not_in_rows(l, none, ["a", "b", "c"], ["x", "y", "z"]).count() == 27


def test_not_in_rows_of_one_column_is_not_in(spark):
    from ledgerline.operators.joins import not_in_rows

    l = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for right in ([], [(1,)], [(1,), (None,)], [(None,)]):
        r = spark.createDataFrame(right, "x int")
        assert rows(not_in_rows(l, r, ["a"], ["x"]), "a") == rows(not_in(l, r, "a", "x"), "a"), right
    plan = not_in_rows(l, r, ["a"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_rows_with_a_third_of_all_rows_tied_on_one_key(spark):
    """No window; the tied rows of the hot key come from many tasks."""
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5).alias("t"), F.col("id").alias("v"),
    )
    out = latest_rows(df, ["k"], "t", ["v"], "top")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("k = 0").count() == n // 3 and out.count() == n
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the data are small
    try:
        parts = latest_rows(df, ["k"], "t", ["v"]).filter("k = 0").select(F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [sum(r.p == p for r in parts) for p in {r.p for r in parts}]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 3 / 8


def test_latest_rows_of_null_keys_and_orders(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (None, 2, "b"), (None, 2, "c"), (1, None, "d"), (2, 5, None), (2, 5, "e")], "k int, t int, v string")
    assert rows(latest_rows(df, ["k"], "t", ["v"]), "k", "t", "v") == sorted([(None, 2, "b"), (None, 2, "c"), (2, 5, None), (2, 5, "e")], key=repr)


def test_interval_join_shuffles_points_once(spark):
    """Also where long intervals exist: their buckets come to the points."""
    pts, ivs = mixed_lengths(spark)
    p, i = spark.createDataFrame(pts, "pid int, k int, d date"), spark.createDataFrame(ivs, "iid int, ik int, s date, e date")
    for longest in (None, 4_000_000):
        out = interval_join(p, i, ["k"], ["ik"], "d", "s", "e", longest=longest)
        got = out.select("p.pid", "i.iid").collect()
        assert sorted([tuple(r) for r in got], key=repr) == brute_interval_join(pts, ivs, "left")
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("LeftOuter") == 1 and len([t for t in text.splitlines() if "Exchange hashpartitioning(p#" in t]) == 1
