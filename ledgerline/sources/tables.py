"""Reading the input tables and storing model outputs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import checkpoint_dir
from ledgerline.sources.versions import WHOLE, Store

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Named-table scan (A1): one Parquet dataset per table under ``base``.

    Only a scan is declared here; Catalyst prunes the columns and pushes the filters of
    whatever is built on top into the Parquet reader.
    """
    path = os.path.join(base, f"{name}.parquet")
    return spark.read.parquet(path)


class Tables:
    """Lazy, cached handles on the raw tables of one data directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = load(self.spark, self.base, name)
        return self._frames[name]


def input_bytes(spark: SparkSession, base: str) -> int:
    """Bytes of all files under ``base``, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength()


def save(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None, cluster_by: Sequence[str] = (), **layout
) -> DataFrame:
    """Model materialisation (A6): write the model as the next version of the table at
    ``path`` (``sources.versions``) and return the stored table.

    The new version is written beside the old one and takes its place by one pointer, so a
    reader (``read_saved``) has the old table or the new one, whole, wherever a write stops.
    The version before stays for those who read it; older ones go.  ``partition_by``,
    ``cluster_by`` and further layout options are those of ``Store.write``.
    """
    store = Store(df.sparkSession, path)
    base = store.current()
    version = store.commit({"": store.write(df, partition_by or (), cluster_by, **layout)}, base)
    store.expire()
    return store.read("", version)


def saved_folder(spark: SparkSession, path: str) -> str:
    """The Parquet folder of the current version of a table that ``save`` wrote."""
    return f"{path.rstrip('/')}/{Store(spark, path).current().tables[''].folders[WHOLE]}"


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``save`` wrote."""
    return Store(spark, path).read("")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table of its own in the shared checkpoint folder and read it back.

    Used between models (paid periods -> paid years, client base -> reports) so the
    downstream models start from a stored table instead of recomputing the lineage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
