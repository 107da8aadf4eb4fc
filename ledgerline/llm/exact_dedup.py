"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text.  A new
batch is reduced to one row per digest (combined map-side, so a text that makes up a third
of the batch reaches the shuffle as a few rows), sort-merge anti-joined with the index and
the digests that remain are appended.  The index side of that join is never shuffled or
sorted again.

Batches have names.  What a batch has put into the index counts as unseen when the same
batch comes again, so a job that died after the append, or in it, is simply run once more.
"""

from __future__ import annotations

import json
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import lookup, open_folder, stage, work_dir
from ledgerline.sources.tables import Tables

INDEX_COLUMNS = "digest BINARY, keep_id BIGINT, batch STRING"
META = "_index.json"  # beside the files: Spark passes over names that begin like this


def text_digest(text: str):
    """SHA-256 of the text after each run of ASCII white space became one space; null
    counts as the empty text."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(F.encode(plain, "UTF-8"), 256))


class DigestIndex:
    """A persistent index of text digests at ``path``.

    The files at ``path`` are the index; the table is only this session's handle for them and
    is named by a digest of the path.  ``buckets`` (default: the session's shuffle
    partitions) is fixed when the index is made and kept beside the files; to reopen the
    index with another number is an error.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = self._made_with(buckets)
        self.table = "digest_index_" + sha256(self.path.encode()).hexdigest()[:32]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def _made_with(self, buckets: int | None) -> int:
        """The number of buckets of the index, which is noted when there is none yet."""
        store, at = open_folder(self.path)
        if store.get_file_info(f"{at}/{META}").is_file:
            with store.open_input_stream(f"{at}/{META}") as f:
                made = json.loads(f.read())["buckets"]
            if buckets not in (None, made):
                raise ValueError(f"the index at {self.path} has {made} buckets, not {buckets}")
            return made
        made = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        store.create_dir(at, recursive=True)
        with store.open_output_stream(f"{at}/{META}") as f:
            f.write(json.dumps({"buckets": made}).encode())
        return made

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Deduplicate ``docs`` against the index and within itself; append what is new.

        Returns one row per input row: doc_id, keep_id (id of the row that stays),
        group_size (rows of this batch with the text), kept, text_sha256.  Of equal texts
        already in the index nothing of this batch stays; of equal new texts the row with
        the smallest id stays, null ids last.  Exactly one row of a group stays also where
        ids are repeated or null.  Null texts are empty texts.  Other columns are ignored.
        An empty batch gives an empty result and leaves the index as it was.

        ``batch`` names the batch.  Run again under its name, after a failure at whatever
        point, it gives the result of a single run and is in the index once.  Without a name
        every call is a batch of its own.
        """
        rows = stage(
            docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"))
            .withColumn("row", F.monotonically_increasing_id()),
            "dedup-digests",
        )
        batch = batch or work_dir(self.spark, "batch").rsplit("-", 1)[1]
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
        groups = rows.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        self._append(
            self.unseen(groups).select("digest", F.col("first.doc_id").alias("keep_id"), F.lit(batch).alias("batch"))
        )
        decided = stage(
            groups.select("digest", "group_size", F.col("first.row").alias("first_row")).join(self.read().hint("merge"), "digest"),
            "dedup-groups",
        )
        out = lookup(rows, decided, "digest", "group_size")
        return out.select(
            "doc_id", "keep_id", "group_size",
            ((F.col("batch") == batch) & (F.col("row") == F.col("first_row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The ``groups`` whose digest is not in the index; its buckets are read as they are.
        What this batch itself has in the index already is not appended again."""
        return groups.join(self.read().hint("merge"), "digest", "left_anti")

    def _append(self, new: DataFrame) -> None:
        (
            new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
            .option("path", self.path).bucketBy(self.buckets, "digest").sortBy("digest")
            .saveAsTable(self.table)
        )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir)["documents"]
    return DigestIndex(spark, work_dir(spark, "digest-index")).add(docs)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
