"""Property tests: operators against an independent statement of the same rule."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.joins import not_in
from ledgerline.operators.latest import latest_by
from ledgerline.operators.quality import duplicate_rows, with_key_count

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=12)


@SETTINGS
@given(left=keys, right=keys)
def test_not_in_equals_sql_not_in(spark, left, right):
    l_df = spark.createDataFrame([(v,) for v in left], "x int")
    r_df = spark.createDataFrame([(v,) for v in right], "y int")
    l_df.createOrReplaceTempView("prop_l")
    r_df.createOrReplaceTempView("prop_r")
    want = spark.sql("SELECT x FROM prop_l WHERE x NOT IN (SELECT y FROM prop_r)").collect()
    got = not_in(l_df, r_df, "x", "y").collect()
    assert Counter(r.x for r in got) == Counter(r.x for r in want)


rows = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 1000)),
    min_size=1, max_size=15, unique_by=lambda r: r[2],
)


@SETTINGS
@given(data=rows)
def test_latest_by_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, t int, id int")
    got = {r.k: r.id for r in latest_by(df, ["k"], "t", ["id"]).collect()}
    want = {}
    for k in {r[0] for r in data}:
        group = [r for r in data if r[0] == k]
        # greatest t first (NULL last), then greatest id
        best = max(group, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        want[k] = best[2]
    assert got == want


@SETTINGS
@given(ids=keys)
def test_duplicate_rows_and_key_count_equal_window_count(spark, ids):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(ids)], "k int, i int")
    df.createOrReplaceTempView("prop_d")
    window = spark.sql(
        "SELECT k, i, count(*) OVER (PARTITION BY k) AS n FROM prop_d"
    ).collect()
    want_counts = {r.i: r.n for r in window}
    got_counts = {r.i: r.n for r in with_key_count(df, "k", "n").collect()}
    assert got_counts == want_counts
    want_dups = sorted(r.i for r in window if r.n > 1)
    assert sorted(r.i for r in duplicate_rows(df, "k").collect()) == want_dups
