import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm.common import open_folder, work_dir
from ledgerline.llm.token_files import read_token_files, word_encoder, words_to_encode, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def library(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def check(spark, docs, pairs):
    path = work_dir(spark, "test-tokens")
    manifest = write_token_files(docs, path, PATH, 2)
    got = read_token_files(spark, path).collect()
    start = 0
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in order]
    by_text = sorted((i is not None, i or 0, np.array([*library(t), 2], "<u4").tobytes()) for i, t in pairs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == by_text
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        start += r.n_tokens
    assert manifest["dtype"] == "<u2" and sum(p["tokens"] for p in manifest["parts"]) == start
    return path


def test_round_trip_with_nulls_repeats_and_long_texts(spark, make_docs):
    pairs = [(7, "Hello, world! It's 42."), (3, None), (None, "no id"), (3, "again"), (3, "again"), (1, ""), (2, "word " * 200_000), (-5, "ÄÖ ñandú x\x1cy\x85z")]
    check(spark, make_docs(pairs), pairs)


def test_files_are_flat_and_listed(spark, make_docs):
    pairs = [(i, f"doc {i}") for i in range(50)]
    path = check(spark, make_docs(pairs), pairs)
    store, base = open_folder(path)
    with store.open_input_stream(f"{base}/manifest.json") as f:
        parts = json.loads(f.read())["parts"]
    for p in parts:
        tokens = np.memmap(f"{base}/{p['file']}.bin", "<u2", "r")
        ends = np.memmap(f"{base}/{p['file']}.idx", "<i8", "r")
        assert len(tokens) == p["tokens"] == ends[-1] and len(ends) == p["docs"] + 1
    assert [p["base"] for p in parts] == [sum(q["tokens"] for q in parts[:k]) for k in range(len(parts))]


def test_empty_table(spark, make_docs):
    path = work_dir(spark, "test-tokens")
    assert write_token_files(make_docs([]), path, PATH, 2)["parts"] == []
    assert read_token_files(spark, path).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_word_by_word_is_the_librarys_encoding(seed):
    rng = random.Random(seed)
    alphabet = ["a", "B", "z", "é", "É", "H̱", "ẖ", "é", "İ", "Σ", "ß", "1", "9", ".", ",", "!", "'", "'s", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n", "\t", "\x1c", "\x85", "　", "中", "😀", "€"]
    memo = word_encoder(PATH, "<u2")
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        assert np.frombuffer(memo.encode(words_to_encode(text.encode(), True)), "<u2").tolist() == library(text), repr(text)


def test_memo_is_bounded():
    from ledgerline.llm.memo import WordMemo

    memo = WordMemo(lambda words: [w.upper() for w in words], 10)
    for k in range(20):
        assert memo.encode([b"a", b"%d" % k, b"%d" % (k + 1)]) == b"A%d%d" % (k, k + 1)
        assert len(memo.known) <= 10


def test_plain_words_go_straight_to_the_model(monkeypatch):
    """Letters of Latin-1, digits and marks take no walk through the library's pipeline, and
    give its ids; other words do."""
    from ledgerline.llm import token_files

    monkeypatch.setattr(token_files, "_ENCODERS", {})
    walked = []

    class Library:
        def __init__(self, whole):
            self.whole, self.model = whole, whole.model

        def encode_batch_fast(self, texts, **options):
            walked.extend(texts)
            return self.whole.encode_batch_fast(texts, **options)

    monkeypatch.setattr("tokenizers.Tokenizer.from_file", lambda path: Library(TOKENIZER), raising=False)
    memo = word_encoder(PATH, "<u2")
    plain = ["word", "Word,", "éÈÿß.", "a1b22", "x!!;?", "--__", "naïve)("]
    odd = ["don't", "a<|endoftext|>", "中文", "á", "x y", "×", "ſ"]
    for word in plain + odd:
        assert np.frombuffer(memo.encode([word.encode()] * 2), "<u2").tolist() == library(word) * 2, word
    assert walked == odd


def test_frequent_words_stay_in_a_bounded_memo():
    from ledgerline.llm.memo import Seen

    made = []
    memo = Seen(lambda w: made.append(w) or w.upper(), 10)
    for k in range(50):
        assert memo.encode([b"a", b"%d" % k]) == b"A%d" % k
        assert len(memo) + len(memo.older) <= 10
    assert made.count(b"a") == 1
