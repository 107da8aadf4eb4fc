import hashlib
import re

import pytest

from ledgerline.llm.common import work_dir
from ledgerline.llm.exact_dedup import DigestIndex


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


@pytest.fixture
def index(spark):
    return DigestIndex(spark, work_dir(spark, "test-index"), 4)


def test_groups_spaces_nulls_and_long_texts(index, make_docs):
    long = "w " * 300_000
    pairs = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (4, " "), (7, long), (6, long + "\n")]
    got = {r.doc_id: r for r in index.add(make_docs(pairs)).collect()}
    want = {}
    for i, t in pairs:
        same = [j for j, u in pairs if digest(u) == digest(t)]
        want[i] = (min(same), len(same), i == min(same), digest(t))
    assert {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in got.items()} == want


def test_one_row_stays_of_repeated_and_null_ids(index, make_docs):
    rows = index.add(make_docs([(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y")])).collect()
    assert sorted((r.text_sha256, r.kept) for r in rows).count((digest("x"), True)) == 1
    assert [r.kept for r in rows if r.text_sha256 == digest("y")].count(True) == 1
    assert {r.keep_id for r in rows if r.text_sha256 == digest("x")} == {1}


def test_second_batch_meets_the_first_and_the_index_reopens(spark, index, make_docs):
    index.add(make_docs([(10, "old"), (11, "both")])).collect()
    again = DigestIndex(spark, index.path, 4)
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(make_docs([(1, "both"), (2, "new"), (3, "new")])).collect()}
    assert got == {1: (11, False), 2: (2, True), 3: (2, False)}
    assert again.read().count() == 3
    assert again.add(make_docs([])).collect() == []


def test_hot_text(index, make_docs):
    pairs = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    rows = index.add(make_docs(pairs)).collect()
    assert len(rows) == 3000
    assert {r.group_size for r in rows if r.doc_id % 3 == 0} == {1000}
    assert sum(r.kept for r in rows) == 2001


def test_the_index_side_is_neither_shuffled_nor_sorted_again(spark, index, make_docs):
    index.add(make_docs([(1, "x")])).collect()
    rows = spark.range(10).selectExpr("unhex(sha2(string(id), 256)) AS digest").repartition(4, "digest")
    plan = rows.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_the_index_is_not_broadcast_or_shuffled_for_the_next_batch(spark, index, make_docs):
    index.add(make_docs([(1, "a"), (2, "b")]))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "10m")
    try:
        groups = make_docs([(3, "c")]).selectExpr("unhex(sha2(text, 256)) digest").groupBy("digest").count()
        plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Broadcast" not in plan
    index_side = plan[plan.index("Exchange"):] if "Exchange" in plan else plan
    assert index_side.count("Exchange") == 1 and "Bucketed: true" in plan


def decisions(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


def test_a_batch_that_failed_after_the_append_is_run_again(spark, index, make_docs, monkeypatch):
    index.add(make_docs([(1, "old")]), batch="first").collect()
    docs = make_docs([(5, "new"), (4, "new"), (6, "old"), (7, None)])
    append = DigestIndex._append

    def dies(self, new):
        append(self, new)
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(DigestIndex, "_append", dies)
        with pytest.raises(RuntimeError, match="died"):
            index.add(docs, batch="second")
    got = decisions(index.add(docs.repartition(3), batch="second"))
    assert [(i, k, kept) for i, k, _, kept, _ in got] == [(4, 4, True), (5, 4, False), (6, 1, False), (7, 7, True)]
    assert got == decisions(index.add(docs, batch="second")) and index.read().count() == 3
    assert not any(r[3] for r in decisions(index.add(docs, batch="third")))


def test_half_an_append_is_completed(spark, index, make_docs, monkeypatch):
    docs = make_docs([(i, f"t{i}") for i in range(40)])
    append = DigestIndex._append
    with monkeypatch.context() as m:
        m.setattr(DigestIndex, "_append", lambda self, new: append(self, new.filter("keep_id % 2 = 0")))
        index.add(docs, batch="b").collect()
    assert index.read().count() == 20
    assert all(r[3] for r in decisions(index.add(docs, batch="b"))) and index.read().count() == 40


def test_indexes_at_like_paths_are_apart(spark, make_docs):
    base = work_dir(spark, "like-paths")
    tail = "a-very-long-common-tail-of-both-of-the-paths-that-goes-on-and-on"
    for one, other in ((f"{base}/x-y", f"{base}/x_y"), (f"{base}/p/{tail}", f"{base}/q/{tail}")):
        a, b = DigestIndex(spark, one, 4), DigestIndex(spark, other, 4)
        a.add(make_docs([(1, "x"), (2, "y")])).collect()
        assert b.read().count() == 0 and [r[3] for r in decisions(b.add(make_docs([(9, "x")])))] == [True]
        assert a.read().count() == 2


def test_an_index_is_not_reopened_with_another_number_of_buckets(spark, index):
    with pytest.raises(ValueError, match="4 buckets"):
        DigestIndex(spark, index.path, 8)
    assert DigestIndex(spark, index.path).buckets == 4
