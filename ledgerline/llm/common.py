"""Helpers shared by the operators: staged tables in the shared folder, hot-key lookups."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

# A key that holds more than 1/HOT_KEYS of all rows counts as hot.  By arithmetic there are
# fewer than HOT_KEYS such keys, whatever the data, so a table of them can be broadcast.
HOT_KEYS = 4096

BATCH_ROWS = 512

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of the session (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-{name}-{uuid.uuid4().hex[:12]}"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI as Spark writes it, and the path on it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on its session sends at most BATCH_ROWS rows at a time to Python, so
    that a batch of long texts stays small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow; at the end of a task Arrow gives back the memory that it keeps for
    the next one, which the worker's later tasks, of other steps, would hold beside their own."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return released


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, so a lost
    executor costs the reading of a file and not the steps before it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def lookup(rows: DataFrame, groups: DataFrame, key: str, count_col: str) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row per ``key``) added; inner join.

    ``count_col`` is the number of rows of each key.  Keys holding more than 1/HOT_KEYS of
    all rows are joined by a broadcast of those fewer than HOT_KEYS groups, so their rows
    are never shuffled to one task; all others go through a shuffled join.  Both inputs
    should be stored tables, as each is read more than once.
    """
    total = groups.agg(F.sum(count_col)).first()[0] or 0
    heavy = F.col(count_col) * F.lit(HOT_KEYS) > F.lit(total)
    hot = groups.filter(heavy)
    by_broadcast = rows.join(F.broadcast(hot), key)
    by_shuffle = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(
        groups.filter(~heavy), key
    )
    return by_broadcast.unionByName(by_shuffle)
