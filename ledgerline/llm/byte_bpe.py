"""Byte-level BPE through sentencepiece.

A rank file is turned into a sentencepiece BPE model without training: one piece per
token, its bytes written as printable characters, its score the negative rank, and a
normaliser that changes nothing.  Each pre-token is encoded by itself; ids decode by the
inverse mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import releasing, small_batches
from ledgerline.llm.memo import WordMemo, slices
from ledgerline.sources.tables import Tables

MEMO_TOKENS = 250_000
UNKNOWN = "<unk>"  # piece 0; token n is piece n + 1


def byte_characters() -> str:
    """A printable character for each byte: itself where Latin-1 prints it, else the next
    free one from U+0100 on."""
    prints = [chr(b).isprintable() and not chr(b).isspace() and b != 0xAD for b in range(256)]
    free = iter(range(256, 512))
    return "".join(chr(b) if prints[b] else chr(next(free)) for b in range(256))


def _field(number: int, value) -> bytes:
    """One field of a protocol-buffer message."""

    def varint(n: int) -> bytes:
        n &= (1 << 64) - 1
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    data = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(data)) + data


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model of a vocabulary given in rank order."""
    normal, unknown, bpe = 1, 2, 2  # piece types, model type
    characters = byte_characters()
    pieces = [(UNKNOWN, 0.0, unknown)]
    pieces += [(t.decode("latin-1").translate(characters), -float(rank), normal) for rank, t in enumerate(tokens)]
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normaliser = _field(1, "identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    body = b"".join(_field(1, _field(1, p) + _field(2, score) + _field(3, kind)) for p, score, kind in pieces)
    return body + _field(2, trainer) + _field(3, normaliser)


@lru_cache(2)
def load_tokens(ranks_path: str) -> list[bytes]:
    """Tokens in rank order from a file of base64 tokens and ranks; ranks run from 0."""
    store, at = fs.FileSystem.from_uri(ranks_path)
    with store.open_input_stream(at) as f:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f.read().splitlines())}
    return [ranks[i] for i in range(len(ranks))]


@lru_cache(2)
def encoder(ranks_path: str) -> WordMemo:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=sentencepiece_model(load_tokens(ranks_path)))
    characters = byte_characters()

    def encode_many(words: list[str]) -> Iterator[bytes]:
        for part in slices(words, 4096):
            mapped = [w.encode().decode("latin-1").translate(characters) for w in part]
            for ids in model.encode(mapped, num_threads=1):
                yield (np.array(ids, "<u4") - 1).astype("<u4").tobytes()

    return WordMemo(encode_many, MEMO_TOKENS)


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_binary())])
DECODED = ENCODED.append(pa.field("decoded", pa.large_binary()))


def encoding(ranks_path: str, pattern: str) -> Callable[[Iterator], Iterator]:
    """The step of ``encode`` on batches of doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, cut = encoder(ranks_path), regex.compile(pattern)

        def ids_of(text: str) -> bytes:
            if len(text) < 1 << 20:
                return memo.encode(cut.findall(text))
            found = (m.group() for m in cut.finditer(text))
            return b"".join(iter(lambda: memo.encode(list(islice(found, 1 << 16))), b""))

        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids = [ids_of(t.as_py() or "") for t in part["text"]]
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], n, pa.array(ids, pa.large_binary())], schema=ENCODED)

    return run


def decoding(ranks_path: str) -> Callable[[Iterator], Iterator]:
    """The step of ``decode`` on the batches of ``encoding``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = load_tokens(ranks_path).__getitem__
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids = [x.as_buffer() for x in part["ids"]]
                texts = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]
                ids = part["ids"].cast(pa.large_binary())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["n_tokens"], ids, pa.array(texts, pa.large_binary())], schema=DECODED
                )

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian uint32).

    Each match of ``pattern`` is encoded separately.  Null texts are empty and have no ids;
    ids of documents may be null or repeated; other columns are ignored.  Matches of a very
    long text are encoded in steps, so memory grows with its ids alone.
    """
    run = encoding(ranks_path, pattern)
    return _rows(docs, id_col, text_col).mapInArrow(releasing(run), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for, to the rows of ``encode``."""
    run = decoding(ranks_path)
    return small_batches(encoded).mapInArrow(releasing(run), "doc_id long, n_tokens long, ids binary, decoded binary")


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """``decode`` of ``encode``, both steps in one Python worker per task: two would stand in
    the executor's memory side by side, and stay there idle while the next job begins."""
    steps = encoding(ranks_path, pattern), decoding(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return steps[1](steps[0](batches))

    return _rows(docs, id_col, text_col).mapInArrow(releasing(run), "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Encode and decode: doc_id, n_tokens and the SHA-256 of the ids and of the bytes."""
    import public_tokenizers

    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = encode_decode(docs, ranks_path, public_tokenizers.PATTERN)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(Tables(spark, sf_dir)["documents"])
