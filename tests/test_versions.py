"""Versions of stored tables; a write that stops anywhere leaves a whole table."""

import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.tables import read_saved, save, saved_folder
from ledgerline.sources.versions import Conflict, Store, bucket_of

STEPS = ["draft", "commit", "committed", "forgotten"]


class Stopped(Exception):
    pass


def folder():
    return tempfile.mkdtemp(prefix="ledgerline-versions-") + "/t"


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("step", STEPS)
def test_a_write_that_stops_leaves_the_old_table_or_the_new_one(spark, monkeypatch, step):
    path = folder()
    for n in (2, 3, 4):
        save(spark.range(n), path)

    def stop(self, name):
        if name == step:
            raise Stopped(name)

    with monkeypatch.context() as m:
        m.setattr(Store, "_step", stop)
        with pytest.raises(Stopped):
            save(spark.range(100, 107), path)
    whole = {True: list(range(4)), False: list(range(100, 107))}[step in ("draft", "commit")]
    assert ids(read_saved(spark, path)) == whole
    save(spark.range(5), path)  # and the next write works
    assert ids(read_saved(spark, path)) == list(range(5))


def test_a_job_that_fails_changes_nothing(spark):
    path = folder()
    save(spark.range(3), path)
    bad = spark.range(5).withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        save(bad, path)
    assert ids(read_saved(spark, path)) == [0, 1, 2]


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark):
    path = folder()
    old = save(spark.range(3), path)
    save(spark.range(50, 60), path)
    assert ids(old) == [0, 1, 2] and ids(read_saved(spark, path)) == list(range(50, 60))


def test_a_model_may_read_the_table_it_replaces(spark):
    path = folder()
    save(spark.range(3), path)
    save(read_saved(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert ids(read_saved(spark, path)) == [1, 2, 3]


def test_one_of_two_writers_wins(spark):
    store = Store(spark, folder())
    base = store.commit({"t": store.write(spark.range(2))}, store.current())

    def write(k):
        try:
            return store.commit({"t": store.write(spark.range(10 * k, 10 * k + 3))}, base)
        except Conflict:
            return None

    store.commit({"t": store.write(spark.range(70, 73))}, base)
    with pytest.raises(Conflict):
        store.commit({"t": store.write(spark.range(80, 83))}, base)
    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(write, (1, 2))) == [None, None]
    assert ids(store.read("t")) == [70, 71, 72]
    assert not [n for n in store._names("_versions") if "draft" in n]


def test_buckets_are_shared_between_versions(spark):
    store, key = Store(spark, folder()), "company"
    rows = spark.range(1000).withColumn("company", F.when(F.col("id") % 50 > 0, F.col("id") % 50))
    first = store.commit({"t": store.write_buckets(rows, key, 8)}, store.current())
    touched = [str(r[0]) for r in spark.createDataFrame([(7,)], "company long").select(bucket_of(key, 8)).collect()]
    old = store.read("t", first, touched)
    new = old.withColumn("id", F.when(F.col("company") == 7, F.col("id") + 10_000).otherwise(F.col("id")))
    second = store.commit({"t": store.write_buckets(new, key, 8, first.tables["t"], touched)}, first)
    want = [r.id + 10_000 * (r.company == 7) for r in rows.collect()]
    assert ids(store.read("t")) == sorted(want) and ids(store.read("t", first)) == list(range(1000))
    shared = {b for b, f in second.tables["t"].folders.items() if first.tables["t"].folders[b] == f}
    assert shared == set(first.tables["t"].folders) - set(touched)
    store.expire(1)
    assert ids(store.read("t")) == sorted(want) and store.numbers() == [2]


def test_empty_tables_and_partitions(spark):
    path = folder()
    assert save(spark.range(0), path).collect() == []
    parts = spark.range(10).withColumn("svc", F.concat(F.lit("s"), F.col("id") % 3))
    stored = save(parts, path, ["svc"])
    assert sorted(stored.columns) == ["id", "svc"] and stored.filter("svc = 's1'").count() == 3
    assert spark.read.parquet(saved_folder(spark, path)).count() == 10
    with pytest.raises(KeyError):
        read_saved(spark, folder())


def row_groups(folder):
    """(file, group) and bounds of company_id of every row group below a folder."""
    import glob

    import pyarrow.parquet as pq

    out = []
    for name in sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True)):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("company_id")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            out.append((stats.min, stats.max))
    return out


@pytest.mark.parametrize("partition_by", [(), ("svc",)])
def test_a_lookup_touches_few_row_groups(spark, partition_by):
    """Stored rows of 20,000 companies in small row groups; one company is in under 1%."""
    path = folder()
    company = (F.col("id") * 7919 % 20_000).alias("company_id")
    rows = spark.range(400_000).select(company, F.concat(F.lit("s"), F.col("id") % 2).alias("svc"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    stored = save(rows, path, partition_by, ["company_id"], row_group_bytes=64 << 10)
    groups = row_groups(saved_folder(spark, path))
    hit = [g for g in groups if g[0] <= 52 <= g[1]]
    assert len(groups) > 200 and len(hit) < 0.01 * len(groups) and len(hit) >= 1
    found = stored.filter("company_id = 52")
    assert found.count() == 20 and "EqualTo(company_id,52)" in found._jdf.queryExecution().executedPlan().toString()


def test_bloom_filters_are_written(spark):
    import glob

    import pyarrow.parquet as pq

    path = folder()
    save(spark.range(1000).withColumnRenamed("id", "company_id"), path, cluster_by=["company_id"])
    plain = folder()
    save(spark.range(1000).withColumnRenamed("id", "company_id"), plain)

    def beyond_data(at):
        """Bytes between the row groups' column chunks and the footer: where filters lie."""
        [name, *_] = sorted(glob.glob(f"{saved_folder(spark, at)}/*.parquet"))
        meta = pq.ParquetFile(name).metadata
        data = sum(meta.row_group(g).column(0).total_compressed_size for g in range(meta.num_row_groups))
        import os

        return os.path.getsize(name) - data - meta.serialized_size

    assert beyond_data(path) > beyond_data(plain) + 1000
