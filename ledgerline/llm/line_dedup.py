"""Line deduplication: drop the lines that many documents share.  DataFrame functions only.

Every line becomes a row (hash, document, position).  The rows are partitioned by range
of (hash, document) and sorted by position within, so the lines of one frequent hash lie
in as many adjacent partitions as they need; streaming over them marks the first
occurrence in each document.  The counts of those per hash are combined map-side.  What
comes back per document is not its text but a sparse bitmap of its lines.

Documents are told apart by id and text: rows that repeat both count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ASCII_SPACE, ascii_lower, lookup, stage
from ledgerline.sources.tables import Tables

WORD = 64  # lines in one word of a bitmap


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _document(id_col: str, text_col: str) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(name, F.lit("\n"), F.coalesce(F.col(text_col), F.lit("")))))


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col="doc_id", text_col="text") -> DataFrame:
    """One row for each document that loses lines: document (its key) and dropped, an array
    of (word, mask): bit i of the mask of word w is set when line 64 w + i goes.  Words
    without such a line are left out.

    A line goes when its key, the line without ASCII white space at its ends and with A-Z
    lower-cased, has at least ``min_chars`` code points and occurs in at least ``min_docs``
    documents.  Null and empty texts are one empty line.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.btrim(ascii_lower("line"), F.lit(ASCII_SPACE))
    lines = (
        docs.select(_document(id_col, text_col).alias("document"), F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
        .select("document", "pos", line.alias("line"))
        .filter(F.length("line") >= min_chars)
        .select(F.unhex(F.md5("line")).alias("hash"), "document", "pos")
    )
    lines = stage(lines, "line-hashes")
    dealt = lines.repartitionByRange(n, "hash", "document").sortWithinPartitions("hash", "document", "pos")
    before = F.lag("pos").over(Window.partitionBy("hash", "document").orderBy("pos"))
    counts = (
        dealt.select("hash", before.isNull().alias("first"))
        .groupBy("hash")
        .agg(F.count_if("first").alias("n_docs"), F.count(F.lit(1)).alias("n_lines"))
        .filter(F.col("n_docs") >= min_docs)
    )
    gone = lookup(lines, stage(counts.select("hash", "n_lines"), "line-counts"), "hash", "n_lines")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    words = (
        gone.groupBy("document", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("mask"))
    )
    return words.groupBy("document").agg(F.collect_list(F.struct("word", "mask")).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc (a struct of all its columns), n_lines, n_dropped and
    kept_text.  A document that loses all lines keeps the empty text; one that loses none
    keeps its text, a null one the empty text."""
    last = F.floor((F.size("lines") - 1) / WORD).cast("int")
    words = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.element_at("masks", w), F.lit(0).cast("long")))
    goes = lambda i: F.call_function("getbit", F.get("words", F.floor(i / WORD).cast("int")), i % WORD) == 1
    kept = F.filter("lines", lambda _, i: ~goes(i))
    loses = F.col("dropped").isNotNull()
    return (
        docs.select(F.struct("*").alias("doc"), _document(id_col, text_col).alias("document"), _lines(F.col(text_col)).alias("lines"))
        .join(bitmaps, "document", "left")
        .select("doc", "lines", "dropped", F.map_from_entries("dropped").alias("masks"))
        .withColumn("words", F.when(loses, words))
        .withColumn("kept", F.when(loses, kept).otherwise(F.col("lines")))
        .select(
            "doc", F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"),
        )
    )


def drop_shared_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` with the lines that ``min_docs`` documents share taken out of ``text``, and
    ``n_chars``, where there is one, counted anew."""
    new = {"text": F.when(F.col("doc.text").isNotNull(), F.col("kept_text")), "n_chars": F.length("kept_text").cast("long")}
    return apply_bitmaps(docs, drop_bitmaps(docs, min_docs)).select(
        *[new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns]
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir)["documents"].select("doc_id", "text")
    out = apply_bitmaps(docs, drop_bitmaps(docs))
    return out.select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), frequent AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, f.key IS NULL AS stays FROM k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
