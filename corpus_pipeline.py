"""The corpus pipeline: documents in, cleaned and encoded documents out.

Toxic documents go, lines that many documents share are taken out, one document of each
group of near copies stays, documents with passages of the benchmark go, and what is left
is encoded with a byte-level BPE and decoded again.  Every stage works on all that the one
before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.byte_bpe import round_trip
from ledgerline.llm.common import stage
from ledgerline.llm.decontaminate import drop_contaminated
from ledgerline.llm.line_dedup import drop_shared_lines
from ledgerline.llm.ngram_join import keep_one
from ledgerline.llm.toxicity import drop_toxic
from ledgerline.sources.tables import load


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_shared_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The first stage is a trained model, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what the one before kept and wrote."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
