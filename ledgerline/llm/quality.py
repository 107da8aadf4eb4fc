"""Quality: ordinal regression on graded ratings, with a cumulative logistic link.

A grade is at most k with the probability sigma(threshold_k - w x): one vector of weights
for all grades and ordered thresholds between them.  x are the shares of hashed features of
the text: words, shapes of tokens (letters, capitals, digits and marks, runs as one), pairs
of shapes, and whether a word repeats the one before; and its length class.  From the
probabilities come the expected grade and the chance of a grade that is high enough.

Fitted on a bounded sample; every document is scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ledgerline.llm.common import small_batches
from ledgerline.llm.samples import held_out, labelled_sample
from ledgerline.llm.words import NOT_SPACE, Words, hash_words, mix, words_of
from ledgerline.sources.tables import Tables

BITS = 16  # of a feature's number
MAX_RATED = 6_000  # documents of each grade in the fitting sample, at most
ROUNDS = 120
KEEP = 0.5  # chance of a high enough grade from which a document is selected
ROWS = 512

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[48:58] = 48


def _number(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)


def shapes(words: Words, raw: np.ndarray) -> np.ndarray:
    """A hash of the shape of each word: its characters by class, runs of a class as one.
    ``raw`` are the texts with their capitals."""
    kinds = _CLASS[raw]
    kinds[(raw >= 65) & (raw <= 90)] = 65
    inside = NOT_SPACE[raw]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | ~inside[1:]
    hashes, _, _ = hash_words(kinds[keep], NOT_SPACE)
    return hashes


def features(words: Words, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the features of each word (a row for each kind), and of the length class
    of each document."""
    shape = shapes(words, raw)
    before, same = np.roll(shape, 1), np.roll(words.hashes, 1) == words.hashes
    starts = words.first[:-1][words.first[:-1] < len(shape)]
    before[starts] = 0
    same[starts] = False
    rows = [_number(words.hashes, 1), _number(shape, 2), _number(shape ^ mix(before), 3), _number(same.astype(np.uint64), 4)]
    length = np.log2(np.diff(words.first) + 1).astype(np.uint64)
    return np.stack(rows), _number(length, 5)


def totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of the words of each document."""
    sums = np.append(0.0, np.cumsum(values))
    return sums[first[1:]] - sums[first[:-1]]


def texts_with_capitals(texts: pa.Array) -> Iterator[tuple[int, Words, np.ndarray]]:
    """Groups of ``words_of`` and the bytes of their texts as they are."""
    buffers = [t.as_buffer() if t.is_valid else b"" for t in texts.cast(pa.large_binary())]
    at = 0
    for n, words in words_of(texts, NOT_SPACE):
        yield n, words, np.frombuffer(b"\n".join([*buffers[at : at + n], b""]), np.uint8)
        at += n


@dataclass
class Model:
    grades: np.ndarray  # in order
    weights: np.ndarray
    thresholds: np.ndarray  # between the grades, ascending

    def position(self, words: Words, raw: np.ndarray) -> np.ndarray:
        numbers, length = features(words, raw)
        share = totals(self.weights[numbers].sum(0), words.first) / np.maximum(np.diff(words.first), 1)
        return share + self.weights[length]

    def chances(self, position: np.ndarray) -> np.ndarray:
        """Of each document and grade but the lowest: the chance of at least this grade."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - position[:, None], -30, 30)))


def fit(groups: Iterable[tuple[int, Words, np.ndarray]], rating: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``rating`` and ``weight`` of each document of the groups, in order."""
    grades, y = np.unique(rating, return_inverse=True)
    data, at = [], 0  # of each group: its first document, and document, number and value of its features
    for n, words, raw in groups:
        rows, length = features(words, raw)
        size = np.diff(words.first)
        owner = np.repeat(np.arange(n), size)
        document, number, value = [np.arange(n, dtype=np.int32)], [length.astype(np.uint16)], [np.ones(n, np.float32)]
        for row in rows:  # shares of the features of each document, equal ones summed
            key, count = np.unique(owner << BITS | row, return_counts=True)
            document.append((key >> BITS).astype(np.int32))
            number.append((key & ((1 << BITS) - 1)).astype(np.uint16))
            value.append((count / size[key >> BITS]).astype(np.float32))
        data.append((slice(at, at + n), *(np.concatenate(x) for x in (document, number, value))))
        at += n
    levels = len(grades) - 1
    reached = np.cumsum(np.bincount(y, weight, levels + 1)[::-1])[::-1][1:] / weight.sum()
    start = -np.log(reached / (1 - reached))  # thresholds that give the shares of the grades
    gaps = np.log(np.maximum(np.diff(start), 1e-3))
    values = np.concatenate([np.zeros(1 << BITS), start[:1], gaps])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    lowest = slice(1 << BITS, (1 << BITS) + 1)
    edge = np.concatenate([[0], np.arange(levels), [levels - 1]])  # thresholds around a grade
    for step in range(1, rounds + 1):
        w, spread = values[: 1 << BITS], np.exp(values[(1 << BITS) + 1 :])
        thresholds = values[lowest][0] + np.append(0.0, np.cumsum(spread))
        position = np.concatenate([np.bincount(document, w[number] * value, of.stop - of.start) for of, document, number, value in data])
        below = 1 / (1 + np.exp(np.clip(position[:, None] - thresholds, -30, 30)))
        padded = np.concatenate([np.zeros((len(y), 1)), below, np.ones((len(y), 1))], axis=1)
        rows = np.arange(len(y))
        low, high = padded[rows, y], padded[rows, y + 1]
        chance = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        d_position = weight * (d_high - d_low) / chance  # of minus the log-likelihood
        d_threshold = np.zeros(levels)
        np.add.at(d_threshold, edge[y], weight * d_low / chance * (y > 0))
        np.add.at(d_threshold, edge[y + 1], -weight * d_high / chance * (y < levels))
        slope = 1e-2 * values
        for of, document, number, value in data:
            slope[: 1 << BITS] += np.bincount(number, d_position[of][document] * value, 1 << BITS)
        slope[lowest] = d_threshold.sum()
        if levels > 1:
            slope[(1 << BITS) + 1 :] = np.cumsum(d_threshold[::-1])[::-1][1:] * spread
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        values = values - 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-3)
    spread = np.exp(values[(1 << BITS) + 1 :])
    return Model(grades, values[: 1 << BITS], values[lowest][0] + np.append(0.0, np.cumsum(spread)))


def learn(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Model | None:
    """Fit on the sample of ``labelled_sample``, which leaves out the documents whose
    crc32(doc_id) mod 4 is 2.  None with fewer than two grades to learn from.  Grades are
    whole numbers; a scale of more than 64 is an error."""
    grades = [r[0] for r in labels.select(column).filter(F.col(column).isNotNull()).distinct().limit(65).collect()]
    if len(grades) > 64:
        raise ValueError("quality grades must be a short ordered scale")
    sample, size = labelled_sample(docs, labels, column, {g: MAX_RATED for g in grades})
    rating = np.array(sample["label"].to_pylist())
    if len(np.unique(rating)) < 2:
        return None
    share = {g: size[g] / (rating == g).sum() for g in np.unique(rating).tolist()}
    weight = np.array([share[g] for g in rating.tolist()])  # back to their share among all labels
    return fit(texts_with_capitals(sample["text"].combine_chunks()), rating, weight / weight.mean())


def rate(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text_col: str = "text", least=None) -> DataFrame:
    """One row per document: doc (a struct of the ``keep`` columns, by default doc_id),
    expected_grade, tail (the chance of a grade of at least ``least``, by default the
    highest), tails (the chances of at least each grade but the lowest).  Null and empty
    texts are rated by their length class; without a model all three are null."""
    keep = keep or ["doc_id"]
    inside = text_col in keep  # then the text is sent once, within the struct
    rows = docs.select(F.struct(*keep).alias("doc"), *([] if inside else [F.col(text_col).alias("text")]))
    number = DoubleType()
    if model is None:
        none = F.lit(None)
        return rows.select(
            "doc", none.cast(number).alias("expected_grade"), none.cast(number).alias("tail"),
            none.cast(ArrayType(number)).alias("tails"),
        )
    schema = StructType([rows.schema["doc"], StructField("expected_grade", number), StructField("tail", number), StructField("tails", ArrayType(number))])
    tail = len(model.thresholds) - 1 if least is None else max(0, int(np.searchsorted(model.grades, least)) - 1)
    steps = np.diff(model.grades.astype(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            found = [model.chances(model.position(words, raw)) for _, words, raw in texts_with_capitals(batch["doc"].field(text_col) if inside else batch["text"])]
            chances = np.concatenate(found)
            columns = [
                batch["doc"], pa.array(model.grades[0] + chances @ steps), pa.array(np.ascontiguousarray(chances[:, tail])),
                pa.array(chances.tolist(), pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "expected_grade", "tail", "tails"])

    return small_batches(rows).mapInArrow(run, schema)


def select_good(docs: DataFrame, labels: DataFrame, chance: float = KEEP) -> DataFrame:
    """The documents whose chance of the highest grade is at least ``chance``, with their
    columns; all of them when there is nothing to learn from."""
    rated = rate(docs, learn(docs, labels), keep=docs.columns)
    return rated.filter(F.coalesce(F.col("tail") >= chance, F.lit(True))).select("doc.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    docs = tables["documents"]
    return rate(docs, learn(docs, tables["labels"])).select(
        F.col("doc.doc_id").alias("doc_id"), held_out(F.col("doc.doc_id")).alias("held_out"), "expected_grade",
        F.col("tail").alias("score"), (F.col("tail") >= KEEP).cast("int").alias("predicted"),
        F.coalesce(F.col("tail") >= KEEP, F.lit(True)).alias("kept"),
    )
