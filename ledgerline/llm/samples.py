"""The bounded sample of labelled documents that the classifiers are fitted on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

MAX_BYTES = 32 << 20  # of text, shared by the labels; each takes documents in the order of a hash of their id
MAX_DOCUMENT = 256 << 10  # of a longer text, its beginning is fitted on


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from every fit: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fitting_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label of the documents that may be fitted on.  Null ids and labels are
    none; a document with several labels has the highest."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(column).alias("label"))
    )


def shares(need: dict[int, int], most: dict[int, int], total: int) -> dict[int, int]:
    """Bytes that each label may take: shares in the proportion of ``most``, and what a label
    doesn't need is left to the others."""
    out, rest = {}, sum(most[k] for k in need)
    for label in sorted(need, key=lambda k: (need[k] / most[k], k)):
        out[label] = total * most[label] // rest
        total -= min(need[label], out[label])
        rest -= most[label]
    return out


def sampled(docs: DataFrame, labels: DataFrame, column: str, most: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """order, doc_id, text and label of at most ``most[label]`` documents of each label, the
    first by a hash of the id, as far as the label's share of MAX_BYTES goes; and the number
    of documents of each label.

    Of rows with equal ids one is taken, of texts over MAX_DOCUMENT bytes the beginning.  A
    label whose documents are all missing or null has nothing to fit on and is an error,
    unless there are no documents at all."""
    marked = fitting_labels(labels, column)
    size = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r["label"] in most}
    chosen = marked.limit(0)
    for label in size:
        some = marked.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[label])
        chosen = chosen.unionByName(some)
    beginning = F.when(F.octet_length("text") <= MAX_DOCUMENT, F.col("text")).otherwise(F.substring("text", 1, MAX_DOCUMENT // 4))
    texts = stage(
        docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", beginning.alias("text"))
        .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select(F.xxhash64("doc_id").alias("order"), "doc_id", "label", F.octet_length("text").cast("long").alias("bytes"), "text"),
        "labelled-texts",
    )
    # The bound is applied to the lengths, so that only the texts that are taken meet.
    in_order = Window.partitionBy("label").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = lambda values: F.coalesce(*[F.when(F.col("label") == k, F.lit(v)) for k, v in values.items()], F.lit(0))
    lengths = (
        texts.select("order", "doc_id", "label", "bytes")
        .select("doc_id", "label", "bytes", F.row_number().over(in_order).alias("number"), F.sum("bytes").over(in_order).alias("sum"))
        .filter(F.col("number") <= each(most))
    )
    need = {r["label"]: r["need"] for r in lengths.groupBy("label").agg(F.sum("bytes").alias("need")).collect()}
    if set(size) - set(need) and not docs.isEmpty():
        raise ValueError(f"no text to fit on for {column} {sorted(set(size) - set(need))}")
    taken = lengths.filter(F.col("sum") <= each(shares(need, most, MAX_BYTES))).select("doc_id")
    return texts.join(F.broadcast(taken), "doc_id").select("order", "doc_id", "text", "label"), size


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: dict[int, int]) -> tuple[pa.Table, dict[int, int]]:
    """Text and label of the rows of ``sampled``, in their order, and the number of documents
    of each label."""
    rows, size = sampled(docs, labels, column, most)
    return rows.orderBy("order", "doc_id").select("text", "label").toArrow().combine_chunks(), size
