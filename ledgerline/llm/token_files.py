"""Token-id output: flat unsigned integer files with 64-bit document offsets.

A token set is a folder with ``manifest.json`` and, for each part, three flat
little-endian files that can be memory-mapped:

    <part>.bin   the token ids, uint16 (vocabularies up to 65,536 ids) or uint32
    <part>.idx   int64 start of each document within the part, and the part's length
    <part>.doc   int64 document ids, then one byte each: 1, or 0 for a null id

Parts are in ascending document order.  The manifest lists them with their base, the
number of ids in all parts before, from prefix sums of the parts' lengths; a document's
global start is the base of its part plus its offset.

A task writes under a name of its own attempt, and only names that the committed task
output reports enter the manifest, so retried and speculative tasks leave no wrong parts.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import open_folder, small_batches, stage, work_dir
from ledgerline.llm.memo import Seen
from ledgerline.sources.tables import Tables

MEMO_WORDS = 1_500_000
FILE_BYTES = 256 << 20  # aimed size of a .bin file
_ENCODERS: dict[tuple, Seen] = {}


# What the tokenizers library does before its model sees a word, where that is known here: plain
# words need no more than lower case and a cut into letters, single digits and runs of marks.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZER = [
    {
        "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed", "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
# ASCII but ' and < (which may begin a special token), and the letters of Latin-1
PLAIN = re.compile(rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PIECES = re.compile(rb"(?:[A-Za-z]|\xc3.)+|[0-9]|[^A-Za-z0-9\xc3]+", re.DOTALL)
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level files write as themselves
HIDDEN = [n for n in range(256) if n not in VISIBLE]
BYTE_LEVEL = {n: 256 + k for k, n in enumerate(HIDDEN)}


def knows_words(tokenizer_path: str) -> bool:
    """Whether the file's steps before the model are those above."""
    with open(tokenizer_path, encoding="utf-8") as f:
        found = json.load(f)
    steps = (found["normalizer"] or {}).get("normalizers"), (found["pre_tokenizer"] or {}).get("pretokenizers")
    tokens = [t["content"] for t in found["added_tokens"]]
    return steps == (NORMALIZER, PRE_TOKENIZER) and all(t.startswith("<") for t in tokens) and not found["truncation"]


def word_encoder(tokenizer_path: str, dtype: str) -> Seen:
    """Encode words with a ``tokenizers`` file whose pre-tokenizer drops white space and
    keeps letters, digits and marks apart: each run of other characters is encoded by
    itself.  Plain words are cut into their pieces here and go straight to the file's model,
    which spares the library's normalizing, matching and bookkeeping of each; all others
    take the whole way."""
    key = (tokenizer_path, dtype)
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        known_steps, model = knows_words(tokenizer_path), tokenizer.model

        def by_library(word: bytes) -> bytes:
            (found,) = tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)
            return np.array(found.ids, dtype).tobytes()

        def piece(word: bytes) -> bytes:
            text = word.decode().lower()
            if not word.isascii():
                text = text.encode().decode("latin-1").translate(BYTE_LEVEL)
            return np.array([t.id for t in model.tokenize(text)], dtype).tobytes()

        def encode_one(word: bytes) -> bytes:
            if not known_steps or not PLAIN.fullmatch(word):
                return by_library(word)
            if word.isalpha():
                return piece(word)
            return b"".join([memo.get(p) or piece(p) for p in PIECES.findall(word)])

        memo = _ENCODERS[key] = Seen(encode_one, MEMO_WORDS)
    return _ENCODERS[key]


def id_type(tokenizer_path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def tokenizer_lowers(tokenizer_path: str) -> bool:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).normalizer.normalize_str("AZ") == "az"


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_to_encode(text: bytes, lower: bool) -> list[bytes]:
    """The words of a text, cut at ASCII white space.  For a tokenizer that composes
    characters and lower-cases, A-Z are lower-cased first, so that more words are alike;
    not where a combining mark could compose differently, or a special token might stand."""
    if lower and not (b"\xcc" in text or b"\xcd" in text or b"<|" in text):
        text = text.translate(LOWER)
    return text.split()


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> dict:
    """Encode ``docs`` and write them as a token set at ``path``; returns the manifest.

    Documents are in ascending id order, null ids first, each followed by ``end_id``;
    documents of equal id follow each other, dealt out by a hash of their text.  A null
    text is empty and has the end id alone.  An empty table gives a set without parts.
    Texts are range-partitioned and sorted first, so that each task encodes and writes one
    part and ids are never shuffled.
    """
    spark = docs.sparkSession
    dtype = id_type(tokenizer_path)
    width = np.dtype(dtype).itemsize
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // FILE_BYTES + 1)
    folder, base = open_folder(path)
    folder.create_dir(base, recursive=True)
    lower = tokenizer_lowers(tokenizer_path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:8]}"
        store, at = open_folder(path)
        memo, end = word_encoder(tokenizer_path, dtype), np.array([end_id], dtype).tobytes()
        lengths, ids, valid = [], [], []
        out = None
        for batch in batches:
            if out is None:
                out = store.open_output_stream(f"{at}/{name}.bin")
            for text in batch["text"]:
                found = memo.encode(words_to_encode(text.as_buffer().to_pybytes() if text.is_valid else b"", lower))
                out.write(found)
                out.write(end)
                lengths.append(len(found) // width + 1)
            ids.append(batch["doc_id"].fill_null(0).to_numpy())
            valid.append(batch["doc_id"].is_valid().to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        ends = np.cumsum(lengths)
        with store.open_output_stream(f"{at}/{name}.idx") as f:
            f.write(np.append(0, ends).astype("<i8").tobytes())
        with store.open_output_stream(f"{at}/{name}.doc") as f:
            f.write(np.concatenate(ids).astype("<i8").tobytes())
            f.write(np.concatenate(valid).astype("u1").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "file": [name], "docs": [len(ends)], "tokens": [int(ends[-1])]}
        )

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    parts = stage(small_batches(ordered).mapInArrow(write, "part long, file string, docs long, tokens long"), "token-parts")
    listed = [r.asDict() for r in parts.orderBy("part").collect()]  # a row for each file
    for row, last in zip(listed, accumulate(r["tokens"] for r in listed)):
        row["base"] = last - row["tokens"]
    manifest = {"dtype": dtype, "end_id": end_id, "parts": listed}
    with folder.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def _map_file(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """One row per document of a token set: doc_id, start (ids of all documents before),
    n_tokens, ids_crc32 (of the ids as uint32), and with ``ids`` the ids as uint32 bytes.
    A task reads one part."""
    folder, base = open_folder(path)
    with folder.open_input_stream(f"{base}/manifest.json") as f:
        manifest = json.loads(f.read())
    parts, dtype = manifest["parts"], manifest["dtype"]
    extra = [("ids", pa.large_binary())] if ids else []
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *extra])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = open_folder(path)
        for k in (k for b in batches for k in b["id"].to_pylist()):
            part = parts[k]
            tokens = _map_file(store, f"{at}/{part['file']}.bin", dtype)
            starts = _map_file(store, f"{at}/{part['file']}.idx", "<i8")
            doc = _map_file(store, f"{at}/{part['file']}.doc", "u1")
            n = part["docs"]
            names, valid = doc[: 8 * n].view("<i8"), doc[8 * n :].astype(bool)
            for lo in range(0, n, 512):
                hi = min(n, lo + 512)
                flat = [tokens[a:b].astype("<u4").tobytes() for a, b in zip(starts[lo:hi], starts[lo + 1 : hi + 1])]
                columns = [
                    pa.array(names[lo:hi], pa.int64(), mask=~valid[lo:hi]),
                    pa.array(starts[lo:hi] + part["base"], pa.int64()),
                    pa.array(np.diff(starts[lo : hi + 1]), pa.int64()),
                    pa.array([zlib.crc32(x) for x in flat], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(flat, pa.large_binary())] if ids else []), schema=schema)

    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, out)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_dir(spark, "token-set")
    write_token_files(Tables(spark, sf_dir)["documents"], path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_token_files(spark, path, ids=False)
