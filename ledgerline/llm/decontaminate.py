"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items.  For each pattern length m a shift
table tells, for a block of words, how far the block's last occurrence in any pattern is
from the patterns' ends: that many positions cannot end an occurrence and are skipped.  At
shift 0 the patterns with that suffix block are compared word by word with the text.

The benchmark is a query set.  It is taken in blocks of bounded size, each of which is one
pass over the documents in the same stage; no document moves, and no block grows with the
documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerline.llm.common import releasing, small_batches
from ledgerline.llm.words import ALNUM, words_of
from ledgerline.sources.tables import Tables

BLOCK_BYTES = 8 << 20  # text of the benchmark searched for in one pass
ROWS = 256  # documents of a batch returned at a time


class WuManber:
    """Search for word sequences of one length."""

    def __init__(self, length: int, patterns: list[tuple[int, ...]]):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.suffix: dict[int, list[int]] = defaultdict(list)
        for n, pattern in enumerate(patterns):
            for end in range(self.block, length + 1):
                key = self.key(*pattern[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.suffix[self.key(*pattern[-self.block :])].append(n)
        self.patterns = patterns

    @staticmethod
    def key(*words: int) -> int:
        """Number of a block; word numbers are under 2**31."""
        return words[0] if len(words) == 1 else words[0] << 31 | words[1]

    def search(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and pattern number of each occurrence in an array of word numbers, in
        which 0 is a word that no pattern has."""
        m, step, shift = self.length, self.default, self.shift.get
        if len(words) < m:
            return
        keys = words if self.block == 1 else words[:-1] << 31 | words[1:]
        blocks = np.where((words if self.block == 1 else np.minimum(words[:-1], words[1:])) > 0, keys, 0).tolist()
        at, last = m - self.block, len(blocks)  # the block that ends the window
        while at < last:
            block = blocks[at]
            jump = shift(block, step) if block else step
            if jump:
                at += jump
                continue
            start = at + self.block - m
            window = tuple(words[start : start + m].tolist())
            for n in self.suffix[block]:
                if self.patterns[n] == window:
                    yield start, n
            at += 1


class Searcher:
    """All windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes], list[int]]], window: int):
        """items: name, words and word hashes of each."""
        hashes = sorted({h for _, _, hs in items for h in hs})
        self.known = np.array(hashes, np.uint64)
        number = {h: n + 1 for n, h in enumerate(hashes)}
        self.text = {number[h]: w for _, ws, hs in items for w, h in zip(ws, hs)}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, _, hs in items:
            ids = [number[h] for h in hs]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                owners[tuple(ids[i : i + m])].add(name)
        by_length = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        self.searches = [WuManber(m, patterns) for m, patterns in sorted(by_length.items())]
        self.owners = [[sorted(owners[p]) for p in s.patterns] for s in self.searches]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0)

    def occurrences(self, numbers: np.ndarray, word) -> Iterator[tuple[int, int, list[str]]]:
        """First and last word (exclusive) of each occurrence, and the items that have it.
        ``word(i)`` are the bytes of a word: equal hashes alone are no occurrence."""
        for search, owners in zip(self.searches, self.owners):
            for start, n in search.search(numbers):
                pattern = search.patterns[n]
                if all(word(start + i) == self.text[x] for i, x in enumerate(pattern)):
                    yield start, start + search.length, owners[n]


def _searchers(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> list[Searcher]:
    """A searcher for each block of the benchmark; at least one, which may be empty."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    made = []
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k).toArrow()
        items = []
        at = 0
        for n, w in words_of(part["text"].combine_chunks() if part.num_rows else pa.array([], pa.string()), ALNUM):
            for i in range(n):
                lo, hi = w.first[i], w.first[i + 1]
                words = [w.lower[a:b].tobytes() for a, b in zip(w.starts[lo:hi], w.ends[lo:hi])]
                items.append((part["name"][at + i].as_py() or "", words, w.hashes[lo:hi].tolist()))
            at += n
        made.append(Searcher(items, window))
    return made


def _merged(ranges: list[tuple[int, int]]) -> list[int]:
    """Disjoint ranges in order, as a flat list of starts and ends."""
    out: list[int] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: list[str] | None = None,
    text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """One row per document: doc (a struct of the ``keep`` columns, by default doc_id),
    n_words, ranges (flat starts and ends of the hit words, disjoint), items (names of the
    items that have an occurring window, sorted as strings).

    Words are runs of ASCII letters, digits and characters from U+0080 on, A-Z lower-cased.
    A window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window.  Null texts have no words; rows repeating an item id are one item
    with the windows of all; an item with a null id is named by the empty string.  An empty
    benchmark hits nothing.
    """
    keep = keep or ["doc_id"]
    inside = text_col in keep  # then the text is sent once, within the struct
    rows = docs.select(F.struct(*keep).alias("doc"), (F.lit(None) if inside else F.col(text_col)).cast("string").alias("text"))
    state = StructType([
        rows.schema["doc"], StructField("text", StringType()), StructField("n_words", LongType()),
        StructField("ranges", ArrayType(LongType())), StructField("items", ArrayType(StringType())),
    ])
    searchers = _searchers(benchmark, window, item_col, "text")
    for k, searcher in enumerate(searchers):
        last = k == len(searchers) - 1
        rows = small_batches(rows).mapInArrow(releasing(_pass(searcher, text_col if inside else None, last)), state)
    return rows.drop("text")


def _pass(searcher: Searcher, field: str | None, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            before = batch.to_pydict() if "ranges" in batch.schema.names else None
            counts, ranges, items = [], [], []
            for n, w in words_of(batch["doc"].field(field) if field else batch["text"], ALNUM):
                numbers = searcher.numbers(w.hashes)
                for i in range(n):
                    lo, hi = w.first[i], w.first[i + 1]
                    found, names = [], set()
                    for a, b, owners in searcher.occurrences(numbers[lo:hi], lambda j: w.lower[w.starts[lo + j] : w.ends[lo + j]].tobytes()):  # noqa: B023
                        found.append((a, b))
                        names.update(owners)
                    if before:
                        old = before["ranges"][len(counts)]
                        found += zip(old[::2], old[1::2])
                        names.update(before["items"][len(counts)])
                    counts.append(int(hi - lo))
                    ranges.append(_merged(found))
                    items.append(sorted(names))
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch["text"]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], text, pa.array(counts, pa.int64()), pa.array(ranges, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=["doc", "text", "n_words", "ranges", "items"],
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any hit word, with their columns."""
    found = find_contamination(docs, benchmark, window, keep=docs.columns)
    return found.filter(F.size("ranges") == 0).select("doc.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    found = find_contamination(tables["documents"], tables["benchmark"])
    n_hit = F.aggregate("ranges", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
                        lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")))["n"]
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (F.size("ranges") > 0).alias("contaminated"),
    )
