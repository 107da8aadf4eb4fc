"""W2-W5 for keys of any size: equal to the window, and no task holds a key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import scan


def table(spark, n, keys):
    rng = random.Random(n + keys)
    rows = [(rng.randrange(keys) if keys and rng.random() > 0.05 else None, i, rng.choice([None, *range(-5, 50)])) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, t int, v int").repartition(5)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n,keys", [(0, 1), (1, 1), (400, 1), (400, 3), (400, 300)])
def test_equal_to_the_window(spark, n, keys):
    df = table(spark, n, keys)
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(scan.running_sum(df, ["k"], ["t"], "v", "s").select(want.columns)) == rows(want)
    want = df.withColumn("a", F.lag("v").over(w)).withColumn("b", F.lead("v").over(w))
    assert rows(scan.neighbours(df, ["k"], ["t"], "v", "a", "b").select(want.columns)) == rows(want)


def test_a_table_that_is_one_key_is_worked_on_by_all_tasks(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("t"), F.lit(1).alias("v"))
    sizes = [r["count"] for r in scan.segments(df, [], ["t"]).groupBy(scan._PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    out = scan.running_sum(df, [], ["t"], "v", "s")
    assert out.filter(F.col("s") != F.col("t") + 1).count() == 0 and out.count() == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("__ll_carry")[0]
