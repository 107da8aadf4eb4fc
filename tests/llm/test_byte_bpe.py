import random

import numpy as np
import public_tokenizers
import tiktoken

from ledgerline.llm.byte_bpe import decode, encode, encode_decode, encoder, load_tokens, round_trip

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    ranks = {t: i for i, t in enumerate(load_tokens(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_the_librarys_and_decode_back(make_docs):
    texts = [None, "", " ", "it's we'll 12 345\n\n\tx  y ", "naïve ÄÖ 中文 😀‍", "<|endoftext|>", "a" * 5000, "\x00\x1c\x85", "word, " * 250_000]
    pairs = [*enumerate(texts), (3, texts[3]), (None, "x")]
    rows = decode(encode(make_docs(pairs), RANKS, public_tokenizers.PATTERN), RANKS).collect()
    own = library()
    got = sorted((repr(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in rows)
    want = sorted((repr(i), len(x := own.encode_ordinary(t or "")), x, (t or "").encode()) for i, t in pairs)
    assert got == want


def test_random_bytes_like_texts():
    import regex

    rng, own, memo = random.Random(1), library(), encoder(RANKS)
    cut = regex.compile(public_tokenizers.PATTERN)
    for _ in range(3000):
        text = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x250), 32, 10, 0x4E00 + rng.randrange(99)])) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(memo.encode(cut.findall(text)), "<u4").tolist() == own.encode_ordinary(text)


def test_empty_table(make_docs):
    assert round_trip(make_docs([])).collect() == []


def test_a_task_has_one_python_worker(make_docs):
    """Both steps run in one worker, with the result of the two operators in a row."""
    docs = make_docs([(1, "it's naïve 中文"), (2, None), (None, "x y")])
    plan = round_trip(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    both, steps = encode_decode(docs, RANKS, public_tokenizers.PATTERN), decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert both.schema == steps.schema and sorted(map(str, both.collect())) == sorted(map(str, steps.collect()))
