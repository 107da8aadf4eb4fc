"""SpotSigs fingerprints: chains of content words that follow common words.

A spot is an anchor, one of the corpus' most common words, with the CHAIN content words
after it; its signature is a hash of both.  The set of its signatures is a document's
fingerprint: it hangs on where natural text stands and passes over lists, tables and markup.

Anchors are counted over all documents: the words that are at least 1/ANCHORS of all words,
which by arithmetic are ANCHORS at most, in whatever language.  All other words are content.
A spot near the end of a text has the content words that are left, one at least.

A text with words but without a spot has one signature, of all its words in order; a text
without words has one of all its bytes; an empty or null text has none.  Equal texts so have
equal fingerprints.

Sets are compared by Jaccard.  Sets of n and m >= n signatures reach a similarity t only if
n >= t m, so documents are partitioned by the logarithm of their set's length to the base
1 / t: partners lie in the same partition or in neighbouring ones (``similar``).
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import lookup, stage
from ledgerline.llm.words import ALNUM, mix, words_of
from ledgerline.sources.tables import Tables

ANCHORS = 1000
CHAIN = 2  # content words of a signature
HELD_WORDS = 1 << 20  # distinct words a task counts before it hands the counts on
RANGE_BYTES = 128 << 20  # aimed size of the texts of one range of ids
BITS = 48  # of a signature: 8 characters of base64
ROWS, GROUP = 512, 4 << 20
_FIRST, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def find_anchors(docs: DataFrame, share: int = ANCHORS, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Sorted hashes of the words that are at least 1/share of all words of the corpus, and
    the bytes of all texts.  A task combines its own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, size = np.empty(0, np.uint64), np.empty(0, np.int64), 0

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": counts, "bytes": np.append(size, np.zeros(len(words) - 1, np.int64))})

        for batch in batches:
            for _, found in words_of(batch["text"], ALNUM):
                size += len(found.lower)
                new, n = np.unique(found.hashes, return_counts=True)
                words, at = np.unique(np.concatenate([words, new]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), len(words)).astype(np.int64)
                if len(words) > HELD_WORDS:
                    yield counted()
                    words, counts, size = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        if len(words):
            yield counted()

    texts = docs.select(F.col(text_col).alias("text"))
    sums = texts.mapInArrow(run, "word long, n long, bytes long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    sums = stage(sums, "word-counts")
    total = sums.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    rows = sums.filter(F.col("n") * F.lit(share) >= F.lit(total["n"] or 0)).select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64)), total["bytes"] or 0


class Sets:
    """Signature sets of some texts: those of text i are ``values[first[i]:first[i + 1]]``."""

    def __init__(self, values: np.ndarray, first: np.ndarray):
        self.values, self.first = values, first
        self.sizes = np.diff(first)

    def encoded(self, i: int) -> str:
        """The set of text i: its signatures in order, 8 characters each."""
        some = self.values[self.first[i] : self.first[i + 1]]
        return base64.b64encode(some.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()

    @classmethod
    def decoded(cls, fingerprints: list[str]) -> Sets:
        raw = [np.frombuffer(base64.b64decode(f), np.uint8).reshape(-1, 6) for f in fingerprints]
        sizes = [len(r) for r in raw]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        if raw:
            wide[:, 2:] = np.concatenate(raw)
        return cls(wide.view(">u8").ravel().astype(np.uint64), np.append(0, np.cumsum(sizes)).astype(np.int64))


def signature_sets(texts: list[str | None], anchors: np.ndarray, chain: int = CHAIN) -> Sets:
    column = pa.array(texts, pa.large_string())
    values, sizes = [], []
    for n, words in words_of(column, ALNUM):
        is_anchor = np.zeros(len(words.hashes), bool)
        if len(anchors):
            is_anchor = anchors[np.minimum(np.searchsorted(anchors, words.hashes), len(anchors) - 1)] == words.hashes
        owner = np.searchsorted(words.first, np.arange(len(words.hashes)), "right") - 1
        content = np.flatnonzero(~is_anchor)
        spots = np.flatnonzero(is_anchor)
        after = np.searchsorted(content, spots)
        signature = mix(words.hashes[spots] * _FIRST)
        for k in range(chain):
            at = np.minimum(after + k, len(content) - 1)
            inside = after + k < len(content)
            if len(content):
                inside &= owner[content[at]] == owner[spots]
            if k == 0:
                kept = inside
            word = np.where(inside, words.hashes[content[at]] if len(content) else np.uint64(0), np.uint64(0))
            signature = mix(signature * _NEXT + word)
        signature, of = signature[kept], owner[spots[kept]]
        # texts without a spot: all their words, or all their bytes
        bare = np.setdiff1d(np.arange(n), of)
        whole = [
            words.hashes[words.first[i] : words.first[i + 1]].tobytes() or words.lower[words.at[i] : words.at[i + 1] - 1].tobytes()
            for i in bare.tolist()
        ]
        digests = [int.from_bytes(sha256(data).digest()[:8], "little") for data in whole if data]
        signature = np.concatenate([signature, np.array(digests, np.uint64)])
        of = np.concatenate([of, bare[[bool(data) for data in whole]]]) if len(bare) else of
        room = np.uint64((1 << BITS) - 1)
        joined = signature & room
        order = np.lexsort([joined, of])
        joined, of = joined[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (joined[1:] != joined[:-1]) | (of[1:] != of[:-1])
        values.append(joined[new])
        sizes.append(np.bincount(of[new], minlength=n))
    sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    return Sets(np.concatenate(values) if values else np.empty(0, np.uint64), np.append(0, np.cumsum(sizes)).astype(np.int64))


def likeness(a: Sets, b: Sets, i: np.ndarray, j: np.ndarray, at_least: float = 0.0) -> np.ndarray:
    """Jaccard of set i[k] of ``a`` with set j[k] of ``b``.  Pairs whose lengths alone keep
    them below ``at_least`` are 0 without being compared.  Two empty sets are equal."""
    n, m = a.sizes[i], b.sizes[j]
    out = np.where((n == 0) & (m == 0), 1.0, 0.0)
    worth = np.flatnonzero((n > 0) & (m > 0) & (np.minimum(n, m) >= at_least * np.maximum(n, m)))
    if len(worth):
        def members(sets: Sets, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            size = sets.sizes[which]
            pair = np.repeat(np.arange(len(which)), size)
            return pair, sets.values[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - sets.first[which], size)]

        pair_a, value_a = members(a, i[worth])
        pair_b, value_b = members(b, j[worth])
        pair, value = np.append(pair_a, pair_b), np.append(value_a, value_b)
        order = np.lexsort([value, pair])
        pair, value = pair[order], value[order]
        twice = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
        shared = np.bincount(pair[1:][twice], minlength=len(worth))
        out[worth] = shared / (n[worth] + m[worth] - shared)
    return np.where(out >= at_least, out, 0.0)


def fingerprints(docs: DataFrame, anchors: np.ndarray, chain: int = CHAIN, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, size and fingerprint of every document, where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            sets = signature_sets(batch["text"].to_pylist(), anchors, chain)
            prints = [sets.encoded(i) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets.sizes, pa.int64()), pa.array(prints)], names=["doc_id", "size", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, size long, fingerprint string")


def length_class(size, at_least: float):
    """The partition of a set of ``size`` signatures: partners that reach ``at_least`` are in
    the same one or the next to either side."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(at_least)) + F.lit(1e-9)).cast("long")


def similar(queries: DataFrame, prints: DataFrame, at_least: float = 0.8) -> DataFrame:
    """All pairs of a query (a row of ``queries``) and a row of ``prints`` with a likeness
    of ``at_least`` (over 0): query_id, doc_id, likeness.  Both have doc_id, size and
    fingerprint; ids tell rows apart and are not null, and a row finds itself if it is in both.

    Of a set of n signatures the n - ceil(at_least n) + 1 rarest, counted over all rows, are
    looked up: partners share one of them.  The lists are kept by length class, a query looks
    into its own and the two beside it, and pairs whose lengths allow no match are never made.
    Sets without signatures are like nothing here.
    """

    def postings(side: DataFrame, keep: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = Sets.decoded(batch["fingerprint"].to_pylist())
                which = pa.array(np.repeat(np.arange(batch.num_rows), sets.sizes))
                columns = [batch[c].take(which) for c in keep] + [pa.array(sets.values.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "signature"])

        return side.select(*keep, "fingerprint").mapInArrow(run, "doc_id long, size long, signature long")

    def rarest(side: DataFrame, counts: DataFrame) -> DataFrame:
        rows = lookup(stage(postings(side, ["doc_id", "size"]), "spot-postings"), counts, "signature", "n")
        listed = F.array_sort(F.collect_list(F.struct("n", "signature")))
        need = F.col("size") - F.ceil(F.col("size") * F.lit(at_least) - F.lit(1e-9)) + 1
        return rows.groupBy("doc_id", "size").agg(listed.alias("listed")).select(
            "doc_id", "size", F.explode(F.slice("listed", F.lit(1), need.cast("int"))["signature"]).alias("signature")
        )

    both = queries.select("size", "fingerprint", "doc_id").unionByName(prints.select("size", "fingerprint", "doc_id"))
    counts = stage(postings(both, ["doc_id", "size"]).groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "spot-counts")
    near = F.explode(F.array(*[length_class(F.col("size"), at_least) + k for k in (-1, 0, 1)])).alias("class")
    asked = rarest(queries, counts).select(F.col("doc_id").alias("query_id"), F.col("size").alias("query_size"), "signature", near)
    held = rarest(prints, counts).withColumn("class", length_class(F.col("size"), at_least))
    fits = F.least("size", "query_size") >= F.greatest("size", "query_size") * F.lit(at_least) - F.lit(1e-9)
    pairs = asked.join(held, ["class", "signature"]).filter(fits).select("query_id", "doc_id").distinct()
    pairs = pairs.join(queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("a")), "query_id")
    pairs = pairs.join(prints.select("doc_id", F.col("fingerprint").alias("b")), "doc_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            every = np.arange(batch.num_rows)
            found = likeness(Sets.decoded(batch["a"].to_pylist()), Sets.decoded(batch["b"].to_pylist()), every, every, at_least - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["doc_id"], pa.array(found)], names=["query_id", "doc_id", "likeness"])

    return pairs.select("query_id", "doc_id", "a", "b").mapInArrow(compare, "query_id long, doc_id long, likeness double").filter("likeness > 0")


def _ranges(keys: DataFrame, n: int) -> list[tuple[int | None, int]]:
    """The first (doc_id, order) of each of at most n ranges of rows, in order."""
    dealt = keys.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "order").select("*", F.spark_partition_id().alias("part"))
    low = dealt.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "order")).alias("low"))
    rows = [(r["low"]["known"], r["low"]["doc_id"], r["low"]["order"]) for r in low.collect()]  # a row for each range
    return [r[1:] for r in sorted(rows, key=lambda r: (r[0], r[1] or 0, r[2]))]


def _range_of(starts: list[tuple[int | None, int]]):
    """Of columns doc_id and order: twice the number of the range, plus 1 for its first key."""
    nulls = sum(i is None for i, _ in starts)
    ids = np.array([i for i, _ in starts[nulls:]], np.int64)
    orders = np.array([o for _, o in starts], np.int64)

    @F.arrow_udf("long")
    def find(doc_id: pa.Array, order: pa.Array) -> pa.Array:
        known = doc_id.is_valid().to_numpy(zero_copy_only=False)
        wanted, order = doc_id.fill_null(0).to_numpy(), order.to_numpy()
        low = np.where(known, nulls + np.searchsorted(ids, wanted), 0)
        high = np.where(known, nulls + np.searchsorted(ids, wanted, "right"), nulls)
        out = low - 1
        first = np.zeros(len(out), bool)
        tied = np.flatnonzero(high > low)  # ranges that begin within the rows of this id
        for start in np.unique(low[tied]).tolist():
            some = tied[low[tied] == start]
            at = orders[start : high[some[0]]]
            out[some] = start + np.searchsorted(at, order[some], "right") - 1
            first[some] = np.isin(order[some], at)
        return pa.array(2 * out + first)

    return find


def with_next(docs: DataFrame, total_bytes: int, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, text, place: partitions of consecutive documents, in order.  The last row of a
    range (place 1) is the first document of the next one, after the last range that of the
    first, so each document of a range (place 0) is followed by the next document.

    Documents are in the order of (doc_id, a hash of the text), null ids first; rows that
    repeat both stay in one range.  A text is shuffled once, and only the first document of
    each range twice; the driver sees one id of each range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("order"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total_bytes // RANGE_BYTES + 1)
    starts = _ranges(stage(rows.select("doc_id", "order"), "spot-keys"), n)
    if not starts:
        return rows.select("doc_id", "text", F.lit(0).alias("place"))
    found = F.col("found")
    number = F.floor(found / 2).cast("long")
    own = F.struct(number.alias("range"), F.lit(0).alias("place"))
    ahead = F.struct(F.pmod(number - 1, F.lit(len(starts))).alias("range"), F.lit(1).alias("place"))
    dealt = rows.withColumn("found", _range_of(starts)("doc_id", "order")).select(
        "doc_id", "order", "text", F.explode(F.when(found % 2 == 1, F.array(own, ahead)).otherwise(F.array(own))).alias("in")
    ).select("doc_id", "order", "text", "in.range", "in.place")
    order = ["range", "place", F.col("doc_id").asc_nulls_first(), "order"]
    return dealt.repartitionById(len(starts), F.col("range").cast("int")).sortWithinPartitions(*order).select("doc_id", "text", "place")


def compare_edits(docs: DataFrame, share: int = ANCHORS, chain: int = CHAIN, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, n_chars, fingerprint; of its edited text, whose last
    floor(n_chars / 2) code points are replaced by the first as many (or all) of the next
    document, edited_sha256, edited_fingerprint and near_edited, the likeness to it; and
    near_next, the likeness to the next document.  Null texts are empty, a single document
    is its own next; see ``with_next`` for the order.  Other columns are ignored."""
    anchors, size = find_anchors(docs, share, text_col)

    def finish(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last text, which is only the next one of the one before."""
        edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for t, after in zip(texts, texts[1:])]
        own, new = signature_sets(texts, anchors, chain), signature_sets(edited, anchors, chain)
        every = np.arange(len(edited))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": [sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": [own.encoded(i) for i in every], "edited_fingerprint": [new.encoded(i) for i in every],
            "near_edited": likeness(own, new, every, every), "near_next": likeness(own, own, every, every + 1),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, ended = [], [], 0, False
        for batch in batches:
            for doc_id, text, place in zip(batch["doc_id"].to_pylist(), batch["text"], batch["place"].to_pylist()):
                if place and ended:  # of equal first rows one is enough
                    continue
                text = text.as_py() or ""
                if texts and (held > GROUP or len(texts) > ROWS or place):
                    yield finish(ids, [*texts, text])
                    ids, texts, held = [], [], 0
                ended = bool(place)
                if not place:
                    ids.append(doc_id)
                    texts.append(text)
                    held += len(text)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, size, id_col, text_col).mapInArrow(run, schema)


def op12_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(Tables(spark, sf_dir)["documents"])
