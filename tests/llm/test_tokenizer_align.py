import os
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerline.llm import tokenizer_align as ta
from ledgerline.llm.byte_bpe import byte_characters
from ledgerline.llm.perfect_hash import PerfectHash
from tests.conftest import SF_SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """By whole texts, one at a time."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    char = {c: i for i, c in enumerate(byte_characters())}
    name = {i: bytes(char[c] for c in p) for p, i in a.get_vocab().items()}

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    laid = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spell_a, spell_b = [name[i] for i in ids_a], [b_bytes(i) for i in ids_b]
        if not text or b"".join(spell_a) != (" " + text).encode() or b"".join(spell_b) != (" " + text).encode():
            laid.append((doc_id, [], [], [], []))
            continue
        ends_a = dict(zip(np.cumsum([len(x) for x in spell_a]).tolist(), range(len(ids_a))))
        ends_b = dict(zip(np.cumsum([len(x) for x in spell_b]).tolist(), range(len(ids_b))))
        both = sorted(ends_a.keys() & ends_b.keys())
        groups, links, i, j = [], [], 0, 0
        for end in both:
            x, y = ends_a[end], ends_b[end]
            groups.append(",".join(map(str, ids_a[i : x + 1])) + "|" + ",".join(map(str, ids_b[j : y + 1])))
            links.append((ids_a[x], ids_b[y]))
            i, j = x + 1, y + 1
        laid.append((doc_id, ids_a, ids_b, groups, links))
    count = Counter(x for *_, links in laid for x in links)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(
        ((d, len(x), len(y), len(g), len(li), sum(count[p] == most[p[1]] for p in li), sum(count[p] for p in li), ";".join(g)) for d, x, y, g, li in laid),
        key=repr,
    )


def found(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return sorted(((*(r[c] for c in names), bytes(r.groups).decode()) for r in df.collect()), key=repr)


TEXTS = [
    "", None, " ", "  ", "\n", " \n \n", "a", "a b  c", "tabs\tand\r\nlines\r\n  end  ", "x\r  y\r", "don't  you'll 12 345", "ends in space ",
    "é ü ß ñ 中文字 한국어", " nbsp  　wide", "<|endoftext|> <s> </s> <unk> <0x0A> <0x41>", "literal ▁ mark and words", "▁", "a▁ b words",
    "\x00 nul \x1c fs \x1f", "emoji 😀😀 é ﬁ", "if (x) {\r\n\treturn;\r\n}\r\n", "  lead", "\n\nlead", "a \x0b b\x0c c", "same words", "same words",
    "word " * 30_000, "z" * 50_000, "tail\x85 x   y",
]


def test_every_column_against_brute_force(spark, make_docs):
    rows = [*enumerate(TEXTS), (None, "no id"), (5, "again"), (5, "again")]
    assert found(ta.align(make_docs(rows), A, B)) == brute(rows)


def test_small_shards_and_a_memo_that_starts_again(spark, make_docs):
    """Many shards, many tasks (several rounds of sums), and most of the corpus' forms."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(70)
    assert found(ta.align(docs, A, B, shard_keys=500)) == brute([tuple(r) for r in docs.collect()])


def test_no_documents(make_docs):
    assert ta.align(make_docs([]), A, B).collect() == []
    assert found(ta.align(make_docs([(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_a_memo_that_starts_again(monkeypatch):
    texts = [f"some words {i} {i % 3}" for i in range(200)]
    both = ta.tokenizers(A, B)
    learnt = []
    plain = ta.Aligner(both, lambda *x: None, lambda: None)
    want = [[plain.segments.groups[i] for i in some] for some in plain.numbers(texts)]
    monkeypatch.setattr(ta, "MEMO_BYTES", 3000)
    short = ta.Aligner(both, lambda *x: None, lambda: learnt.append(1))
    got = []
    for lo in range(0, 200, 10):
        got += [[short.segments.groups[i] for i in some] for some in short.numbers(texts[lo : lo + 10])]
    assert got == want and len(learnt) > 5


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n))
    hashed = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
    at = hashed.index(keys)
    assert sorted(at.tolist()) == list(range(len(keys))) and hashed.size == len(keys)
    in_order = np.empty(len(keys), np.int64)
    in_order[at] = keys
    strangers = np.setdiff1d(np.random.default_rng(n + 1).integers(0, 1 << 62, 500), keys)
    assert (hashed.verified_index(keys, in_order) == at).all() and (hashed.verified_index(strangers, in_order) == -1).all()


def test_equal_keys_have_no_perfect_hash():
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([5, 5]))


def test_query_has_the_digest_of_the_groups(spark):
    rows = {r.doc_id: r for r in ta.op13_tokenizer_align(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    for doc_id, *_, groups in brute([tuple(r) for r in docs]):
        assert rows[doc_id].groups_sha256 == (sha256(groups.encode()).hexdigest() if groups else "")
