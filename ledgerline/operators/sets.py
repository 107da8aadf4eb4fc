"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL`` matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``UNION``: rows of all inputs, duplicates removed (one aggregate over the union,
    combined map-side)."""
    return union_all(*frames).distinct()


REPEAT_CHUNK = 10_000  # copies made from one row by one task at a time


def repeat_rows(df: DataFrame, count_col: str) -> DataFrame:
    """Each row of ``df`` repeated ``count_col`` times (the multiplicity a join adds when
    none of its columns is read); ``count_col`` is dropped.  A NULL count, and one below 1,
    gives no row.

    Every count is cut into chunks of at most REPEAT_CHUNK copies, and the chunks are dealt
    out by hash to a fixed number of partitions, which AQE leaves as it is, before they
    expand: the copies of one row are made by many tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.col(count_col).cast("long")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / REPEAT_CHUNK))
    chunks = df.withColumn("__ll_chunk", F.explode(F.when(n > 0, numbers)))
    dealt = chunks.repartition(parts, F.xxhash64(*df.columns), "__ll_chunk")
    copies = F.least(F.lit(REPEAT_CHUNK).cast("long"), n - F.col("__ll_chunk") * REPEAT_CHUNK)
    expanded = dealt.withColumn("__ll_rep", F.explode(F.array_repeat(F.lit(True), copies.cast("int"))))
    return expanded.drop("__ll_rep", "__ll_chunk", count_col)
