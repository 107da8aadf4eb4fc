"""Alignment of two tokenizers over a corpus, and how often each pair of ids is linked.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a sentencepiece model
with byte fallback that puts a space before a text.  Both encode space + text; where tokens
of both end at the same byte, the two are linked, and such offsets cut the tokens into
groups.  Texts whose tokens don't spell space + text exactly, null and empty ones have none.

Counts of pairs, over all documents:

1. A first pass aligns the documents; each task returns its distinct pairs with their counts.
2. The distinct pairs are dealt into shards by a hash, and each shard has a minimal perfect
   hash: the counts of a shard are a dense vector without any keys' gaps.
3. The vectors of FAN tasks are summed, then those of FAN such sums, and so on up the tree.
4. A second pass aligns the documents again and looks the counts up: perfect hash, key
   verified, vector.  Workers read shards from the shared folder as they meet them and hold
   CACHE_BYTES of them, so neither the pairs nor the counts are ever broadcast whole.

The highest count of each B id is a vector as long as B's vocabulary, which bounds what the
driver collects and sends.

A text is aligned by segments that neither tokenizer merges across (see ``_CUT``), and each
worker keeps a bounded memo of segments from task to task; results never depend on it.
"""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import byte_characters
from ledgerline.llm.common import open_folder, stage, work_dir
from ledgerline.llm.perfect_hash import PerfectHash
from ledgerline.llm.words import mix
from ledgerline.sources.tables import Tables

SHARD_KEYS = 1 << 15  # pairs of a shard, about
FAN = 8
CACHE_BYTES = 128 << 20
MEMO_BYTES = 208 << 20
ROWS = 512
MARK = "▁"  # sentencepiece's space

# Segments end before a space or line feed that follows something else than white space.
# Byte-level BPE never merges from such a place on into what follows it, and sentencepiece
# doesn't when no piece has a space after another character, or a line feed at all.
_CUT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
_WHOLE = re.compile(r"(?s).+")


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the pattern that cuts texts."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        store, at = fs.FileSystem.from_uri(a_path)
        with store.open_input_stream(at) as f:
            source = f.read().decode()
        self.a = Tokenizer.from_str(source)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        from_char = {c: b for b, c in enumerate(byte_characters())}
        pieces = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(pieces.values()) + 1)
        for piece, i in pieces.items():
            self.a_bytes[i] = bytes(map(from_char.__getitem__, piece)) if from_char.keys() >= set(piece) else piece.encode()
        b_pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(b_pieces)
        ]
        self.space = self.b.piece_to_id(MARK)
        before = json.loads(source)["pre_tokenizer"] or {}
        safe = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        safe = safe and json.loads(source)["normalizer"] is None
        safe = safe and not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in b_pieces)
        self.cut = _CUT if safe else _WHOLE
        self.by_rank = self._by_rank(json.loads(source)) if safe else None

    def _by_rank(self, source: dict):
        """The same encoder by ranks, which starts faster on short texts: where every byte
        has an id and merges make ids in their order, the first merge is that of the least id."""
        import public_tokenizers
        import tiktoken

        vocabulary, merges = source["model"]["vocab"], source["model"]["merges"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        in_order = all(vocabulary.get("".join(pair)) == 256 + i for i, pair in enumerate(pairs))
        if not in_order or any(len(t) != 1 for t in self.a_bytes[:256]) or source["model"].get("ignore_merges"):
            return None
        ranks = {t: i for i, t in enumerate(self.a_bytes[: 256 + len(merges)])}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, segments: list[str]) -> list[list[int]]:
        if self.by_rank:
            # without the wrapper that mends lone surrogates: texts from Arrow have none
            return list(map(self.by_rank._core_bpe.encode_ordinary, segments))
        return [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]

    def encode_b(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments.  The space that sentencepiece adds stands for a segment's own
        first space; before a line feed it is a token by itself and is taken off."""
        out = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return [([self.space] if s == " " else ids) if s[0] == " " else ids[1:] for s, ids in zip(segments, out)]


@lru_cache(1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(a_path, b_path)


class Segments:
    """The segments met so far, by number: ids, pairs and the text of their groups."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.a_length = np.array([len(t) for t in both.a_bytes])
        self.b_length = np.array([len(t) for t in both.b_bytes])
        # tokens in decimal, with what can stand after one
        self.written = [f"{i}{after}".encode() for after in ",|,;" for i in range(max(len(both.a_bytes), len(both.b_bytes)))]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []  # each ends with a semicolon
        self.sizes = np.zeros((0, 4), np.int64)  # A tokens, B tokens, links, whether the bytes are right
        self.bytes = 0

    def add(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number and pairs (A id << 32 | B id) of links of new segments, in their order."""
        a, b = self.both.encode_a(segments), self.both.encode_b(segments)
        right = self._right(segments, a, b)
        for k in np.flatnonzero(~right).tolist():
            a[k], b[k] = [], []
        sizes = np.array([list(map(len, a)), list(map(len, b))], np.int64).T
        ids_a, ids_b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a_length[ids_a]), np.cumsum(self.b_length[ids_b])
        # both sides spell the same bytes, so equal offsets are equal ends, over all segments
        common, in_a, in_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        first = np.append(0, np.cumsum(sizes, axis=0)[:, 0])
        owner = np.searchsorted(first, in_a, "right") - 1
        links = np.bincount(owner, minlength=len(segments))
        # written: the A tokens of a group, then its B tokens
        n = len(self.written) // 4
        codes = np.concatenate([ids_a, 2 * n + ids_b])
        last = np.concatenate([in_a, len(ids_a) + in_b])
        codes[last] += n
        rank = np.concatenate([2 * np.searchsorted(common, ends_a), 2 * np.searchsorted(common, ends_b) + 1])
        codes = codes[np.argsort(rank, kind="stable")].tolist()
        stops = np.cumsum(sizes.sum(1)).tolist()
        parts = list(map(self.written.__getitem__, codes))
        start = len(self.groups)
        self.groups += [b"".join(parts[i:j]) for i, j in zip([0, *stops], stops)]
        self.known.update(zip(segments, range(start, start + len(segments))))
        self.sizes = np.concatenate([self.sizes, np.column_stack([sizes, links, right])])
        self.bytes += sum(map(len, segments)) * 2 + sum(map(len, self.groups[start:])) + 24 * len(in_a) + 350 * len(segments)
        return links, ids_a[in_a] << 32 | ids_b[in_b]

    def _right(self, segments: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of both sides spell each segment: by all of them at once, and
        only where something is wrong one by one."""
        want = [s.encode() for s in segments]
        lengths = np.cumsum(list(map(len, want)))
        right = np.ones(len(want), bool)
        for side, spelt, length in ((a, self.both.a_bytes, self.a_length), (b, self.both.b_bytes, self.b_length)):
            ids = np.fromiter(chain.from_iterable(side), np.int64)
            stops = np.cumsum(list(map(len, side)))
            if not (np.append(0, np.cumsum(length[ids]))[stops] == lengths).all() or b"".join(map(spelt.__getitem__, ids.tolist())) != b"".join(want):
                right &= [b"".join(map(spelt.__getitem__, some)) == w for some, w in zip(side, want)]
        return right

    def cut(self, texts: list[str | None]) -> list[list[str]]:
        """The segments of space + text; none for null and empty texts."""
        find = self.both.cut.findall
        return [find(" " + t) if t else [] for t in texts]

    def full(self) -> bool:
        return self.bytes > MEMO_BYTES


class Aligner:
    """Numbers the segments of batches of texts, and has ``learn`` look at the new ones;
    ``forget`` is called before the memo starts again."""

    def __init__(self, both: Tokenizers, learn, forget):
        self.segments, self.learn, self.forget = Segments(both), learn, forget

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """The segments of each text.  A text with a segment whose bytes come out wrong is
        taken as one segment; one that is still wrong has none."""
        s = self.segments
        if s.full():
            self.forget()
            s.clear()
        cut = s.cut(texts)
        self._add(set(chain.from_iterable(cut)))
        right = s.sizes[:, 3].astype(bool)
        at = s.known.__getitem__
        out = [list(map(at, some)) for some in cut]
        wrong = [] if right.all() else [k for k, some in enumerate(out) if some and not right[some].all()]
        self._add({" " + texts[k] for k in wrong})
        for k in wrong:
            i = at(" " + texts[k])
            out[k] = [i] if s.sizes[i, 3] else []
        return out

    def _add(self, wanted: set[str]) -> None:
        new = list(wanted.difference(self.segments.known))
        if new:
            self.learn(*self.segments.add(new))


_HELD: dict[str, tuple] = {}  # what a worker keeps for its next task, of one pass at a time


def held(name: str, make):
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, and fewer where texts are long."""
    for batch in batches:
        lo = 0
        lengths = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch["text"]])
        while lo < batch.num_rows:
            size = max(1, int(np.searchsorted(np.cumsum(lengths[lo : lo + ROWS]), 4 << 20)))
            yield batch.slice(lo, size)
            lo += size


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """key (A id << 32 | B id), slot (a hash of it), part (of the input) and count of the
    pairs that each part of the input links; a part that fills its memo has several rows of
    a pair, and pairs of a memo that the part itself doesn't link count 0."""

    def make() -> tuple:
        links: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        return Aligner(tokenizers(a_path, b_path), lambda n, some: (links.append(n), keys.append(some)), None), links, keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        aligner, links, keys = held(f"count {a_path} {b_path}", make)
        seen, full = [], []

        def flush() -> None:
            if links:
                times = np.zeros(sum(map(len, links)), np.int64)
                for number, n in seen:
                    times[number] += n
                every = np.repeat(times, np.concatenate(links))
                found, at = np.unique(np.concatenate(keys), return_inverse=True)
                count = np.bincount(at, every, len(found)).astype(np.int64)
                slot = (mix(found.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
                full.append(pa.RecordBatch.from_pydict({"key": found, "slot": slot, "part": np.full(len(found), part), "count": count}))
            seen.clear()

        def forget() -> None:
            flush()
            links.clear()
            keys.clear()

        aligner.forget = forget
        for batch in texts_of(batches):
            numbers = aligner.numbers(batch["text"].to_pylist())
            yield from full
            full.clear()
            seen.append(np.unique(np.fromiter(chain.from_iterable(numbers), np.int64), return_counts=True))
        flush()
        yield from full

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, slot long, part long, count long")


def read_shard(path: str, shard: int) -> dict:
    """The row of a shard, from a table that is partitioned by shard."""
    store, at = open_folder(path)
    files = store.get_file_info(fs.FileSelector(f"{at}/shard={shard}"))
    names = [f.path for f in files if f.path.endswith(".parquet") and f.size]
    return pq.read_table(names[0], filesystem=store).to_pylist()[0]


def sum_vectors(partial: DataFrame, hashes: str) -> DataFrame:
    """shard, counts (a dense vector of int64 in the order of the shard's perfect hash), of
    the rows of ``pair_counts`` with their shard: summed up a tree, FAN to one."""
    tasks = partial.sparkSession.conf.get("spark.sql.shuffle.partitions")
    top = partial.agg(F.max("part")).first()[0] or 0

    def summed(rows: DataFrame, add) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, vector, more = None, None, {}
            for batch in batches:
                groups = np.stack([batch["shard"].to_numpy(), batch["node"].to_numpy()])
                edges = [0, *(np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
                for lo, hi in zip(edges, edges[1:]):
                    if lo == hi:
                        continue
                    group = tuple(groups[:, lo].tolist())
                    if group != now:
                        if now:
                            yield row(now, vector)
                        now, vector = group, None
                    vector = add(group[0], vector, batch.slice(lo, hi - lo), more)
            if now:
                yield row(now, vector)

        def row(group: tuple, vector: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"shard": [group[0]], "node": [group[1]], "counts": [vector.astype("<i8").tobytes()]})

        rows = rows.withColumn("node", F.floor(F.col("node") / FAN))
        dealt = rows.repartition(int(tasks), "shard", "node").sortWithinPartitions("shard", "node")
        return dealt.mapInArrow(run, "shard long, node long, counts binary")

    def place(shard: int, vector: np.ndarray | None, batch: pa.RecordBatch, more: dict) -> np.ndarray:
        if more.get("shard") != shard:
            row = read_shard(hashes, shard)
            more.update(shard=shard, hash=PerfectHash.from_bytes(row["hash"]), keys=np.frombuffer(row["keys"], "<i8"))
        at = more["hash"].verified_index(batch["key"].to_numpy(), more["keys"])
        vector = np.zeros(len(more["keys"]), np.int64) if vector is None else vector
        np.add.at(vector, at, batch["count"].to_numpy())
        return vector

    def plus(shard: int, vector: np.ndarray | None, batch: pa.RecordBatch, more: dict) -> np.ndarray:
        some = [np.frombuffer(x.as_buffer(), "<i8") for x in batch["counts"]]
        return sum(some, np.zeros(len(some[0]), np.int64) if vector is None else vector)

    out, nodes = summed(partial.withColumn("node", F.col("part")), place), top // FAN
    while nodes:
        out, nodes = summed(out, plus), nodes // FAN
    return out.select("shard", "counts")


class Counts:
    """Counts of pairs from the shards in the shared folder; the last used are held."""

    def __init__(self, path: str, shards: int):
        self.path, self.shards = path, shards
        self.held: OrderedDict[int, tuple] = OrderedDict()
        self.bytes = 0

    def _shard(self, shard: int) -> tuple:
        if shard not in self.held:
            row = read_shard(self.path, shard)
            hashed = PerfectHash.from_bytes(row["hash"])
            self.held[shard] = (hashed, np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["counts"], "<i8"))
            self.bytes += 40 * hashed.size
            while self.bytes > CACHE_BYTES and len(self.held) > 1:
                self.bytes -= 40 * self.held.popitem(last=False)[1][0].size
        self.held.move_to_end(shard)
        return self.held[shard]

    def of(self, keys: np.ndarray) -> np.ndarray:
        found, at = np.unique(keys, return_inverse=True)
        shard = ((mix(found.astype(np.uint64)) >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        out = np.empty(len(found), np.int64)
        for lo, hi in zip(edges, edges[1:]):
            some = order[lo:hi]
            hashed, in_order, counts = self._shard(int(shard[some[0]]))
            index = hashed.verified_index(found[some], in_order)
            if (index < 0).any():
                raise KeyError(f"a pair of the second pass is not among those of the first, shard {shard[some[0]]}")
            out[some] = counts[index]
        return out[at]


def count_table(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", shard_keys: int = SHARD_KEYS) -> tuple[str, int]:
    """Folder and number of shards of the table of counts: shard, n, hash, keys, counts."""
    spark = docs.sparkSession
    partial = stage(pair_counts(docs, a_path, b_path, text_col), "pair-counts")
    keys = stage(partial.select("key", "slot").distinct(), "pairs")
    shards = keys.count() // shard_keys + 1
    shard = (F.col("slot") % shards).alias("shard")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.sort(table["key"].to_numpy())
        hashed = PerfectHash.of(keys)
        in_order = np.empty(len(keys), "<i8")
        in_order[hashed.index(keys)] = keys
        return pa.table({"shard": [key[0].as_py()], "n": [len(keys)], "hash": [hashed.to_bytes()], "keys": [in_order.tobytes()]})

    hashes = work_dir(spark, "pair-hashes")
    hashed = keys.select(shard, "key").groupBy("shard").applyInArrow(build, "shard long, n long, hash binary, keys binary")
    hashed.write.partitionBy("shard").parquet(hashes)
    counts = sum_vectors(partial.select(shard, "part", "key", "count"), hashes)
    path = work_dir(spark, "pair-vectors")
    table = spark.read.schema("n long, hash binary, keys binary, shard long").parquet(hashes)
    table.join(counts, "shard").write.partitionBy("shard").parquet(path)
    return path, shards


def highest_of_b(spark: SparkSession, path: str) -> np.ndarray:
    """The highest count of each B id; as long as B's vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"]):
                b = np.frombuffer(keys.as_buffer(), "<i8") & 0xFFFFFFFF
                ids, at = np.unique(b, return_inverse=True)
                most = np.zeros(len(ids), np.int64)
                np.maximum.at(most, at, np.frombuffer(counts.as_buffer(), "<i8"))
                yield pa.RecordBatch.from_pydict({"id": ids, "most": most})

    table = spark.read.schema("keys binary, counts binary").parquet(path)
    most = table.mapInArrow(run, "id long, most long").groupBy("id").agg(F.max("most").alias("most")).toArrow()
    out = np.zeros(max(most["id"].to_pylist(), default=0) + 1, np.int64)
    out[most["id"].to_numpy()] = most["most"].to_numpy()
    return out


def align(docs: DataFrame, a_path: str, b_path: str, id_col="doc_id", text_col="text", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per document: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links
    whose pair counts as often as any of their B id), count_sum (of the counts of the links)
    and groups (``a1,a2|b1;a3|b2``, as UTF-8).  Documents without tokens have zeros and an
    empty text; ids may be null or repeated, every row counts; other columns are ignored."""
    path, shards = count_table(docs, a_path, b_path, text_col, shard_keys)
    highest = highest_of_b(docs.sparkSession, path)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in names), ("groups", pa.large_binary())])

    def make() -> tuple:
        counts = Counts(path, shards)
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]  # of each segment: best links, sum of counts

        def learn(links: np.ndarray, keys: np.ndarray) -> None:
            of_segment, times = np.repeat(np.arange(len(links)), links), counts.of(keys)
            best = np.bincount(of_segment, times == highest[keys & 0xFFFFFFFF], len(links))
            found[0] = np.concatenate([found[0], np.column_stack([best, np.bincount(of_segment, times, len(links))]).astype(np.int64)])

        def forget() -> None:
            found[0] = found[0][:0]

        return Aligner(tokenizers(a_path, b_path), learn, forget), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, found = held(f"look up {path}", make)
        s = aligner.segments
        for batch in texts_of(batches):
            numbers = aligner.numbers(batch["text"].to_pylist())
            table = np.column_stack([s.sizes[:, [0, 1, 2, 2]], found[0]])
            sums = np.array([table[some].sum(0) for some in numbers]).reshape(len(numbers), 6)
            groups = [b"".join(map(s.groups.__getitem__, some))[:-1] for some in numbers]
            columns = [batch["doc_id"], *(pa.array(c) for c in sums.T), pa.array(groups, pa.large_binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", groups binary")


def op13_tokenizer_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = Tables(spark, sf_dir)["documents"]
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = F.when(F.octet_length("groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return align(docs, *paths).withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256")
