import random
import re
from bisect import bisect
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from ledgerline.llm import spot_signatures as spots
from tests.conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def words(text):
    return find((text or "").translate(LOWER))


def signatures(text, anchors):
    w = words(text)
    found = set()
    content = [i for i, x in enumerate(w) if x not in anchors]
    for i, a in enumerate(w):
        k = bisect(content, i)
        after = [w[j] for j in content[k : k + spots.CHAIN]]
        if a in anchors and after:
            found.add((a, *after))
    if not found and text:
        found = {("all", *w) if w else ("bytes", text.translate(LOWER))}
    return found


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows, share):
    """rows: (doc_id, text) without ties."""
    counts = Counter(x for _, t in rows for x in words(t))
    anchors = {x for x, n in counts.items() if n * share >= sum(counts.values())}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (signatures(t, anchors) for t in (text, edited, after))
        out.append((i, len(text), sha256(edited.encode()).hexdigest(), len(a), len(b), round(jaccard(a, b), 9), round(jaccard(a, c), 9)))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, len(r.fingerprint) // 8, len(r.edited_fingerprint) // 8, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows),
        key=repr,
    )


def texts(n, seed=1):
    rng = random.Random(seed)
    common, rare = ["the", "und", "of", "à"], [f"w{k}é" for k in range(300)]
    return [" ".join(rng.choice(common if rng.random() < 0.4 else rare) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_every_column_against_brute_force(spark, make_docs):
    rows = [*enumerate(texts(120)), (500, None), (501, ""), (502, "!!! ???"), (503, "\U0001f600\U0001f600 é"), (504, "lone"), (505, "the"), (506, "the of the"), (None, "the w1é of w2é")]
    rows += [(600, "the w3é " * 40_000), (-7, "w5é the w6é")]
    assert found(spots.compare_edits(make_docs(rows), share=50)) == brute(rows, 50)


def test_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert found(spots.compare_edits(docs)) == brute([tuple(r) for r in docs.collect()], spots.ANCHORS)


def test_one_document_and_none(make_docs):
    assert found(spots.compare_edits(make_docs([(3, "the end of the word")]), share=2)) == brute([(3, "the end of the word")], 2)
    assert spots.compare_edits(make_docs([])).collect() == []
    [row] = spots.compare_edits(make_docs([(None, None)])).collect()
    assert (row.fingerprint, row.near_edited, row.near_next) == ("", 1.0, 1.0)


def test_repeated_ids_follow_each_other_and_equal_texts_are_equal(make_docs):
    """40 rows of one id, four texts ten times each: each text's rows stand together."""
    rows = [(7, t) for t in texts(4, 3) for _ in range(10)] + [(1, texts(1, 9)[0])]
    out = spots.compare_edits(make_docs(rows), share=50).collect()
    assert len(out) == len(rows) and len({r.fingerprint for r in out}) == 5
    assert sum(r.near_next == 1.0 for r in out) == 4 * 9


@pytest.mark.parametrize("n", [1, 2, 5, 20])
def test_ranges_of_tied_and_null_ids(n):
    rng = np.random.default_rng(n)
    keys = sorted({(None if i == 0 else int(i), int(o)) for i, o in rng.integers(0, 6, (80, 2))}, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    starts = keys[:: max(1, len(keys) // n)]
    import pyarrow as pa

    got = spots._range_of(starts).func(pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())).to_pylist()
    want, at = [], -1
    for k in keys:
        at += k in starts
        want.append(2 * at + (k in starts))
    assert got == want


def test_similar_finds_all_pairs(spark, make_docs):
    rng = random.Random(5)
    base = [t for t in texts(60, 7) if len(words(t)) > 8]
    rows = []
    for i, t in enumerate(base):
        rows.append((10 * i, t))
        for k in range(1, 4):
            w = t.split(" ")
            w[rng.randrange(len(w))] = f"new{k}"
            rows.append((10 * i + k, " ".join(w)))
    docs = make_docs(rows + [(9000, None), (9001, "")])
    anchors, _ = spots.find_anchors(docs, 50)
    prints = spots.stage(spots.fingerprints(docs, anchors), "prints")
    got = {(r.query_id, r.doc_id): round(r.likeness, 9) for r in spots.similar(prints.filter("doc_id % 20 = 0"), prints).collect()}
    counts = Counter(x for _, t in rows for x in words(t))
    common = {x for x, n in counts.items() if n * 50 >= sum(counts.values())}
    sets = {i: signatures(t, common) for i, t in rows}
    want = {(q, d): round(jaccard(sets[q], sets[d]), 9) for q in sets if q % 20 == 0 for d in sets if jaccard(sets[q], sets[d]) >= 0.8}
    assert got == want and len(want) > len([q for q in sets if q % 20 == 0])


def test_sets_survive_their_encoding():
    sets = spots.signature_sets(["the a the b", "", "x"], np.empty(0, np.uint64))
    again = spots.Sets.decoded([sets.encoded(i) for i in range(3)])
    assert (again.values == sets.values).all() and (again.first == sets.first).all()
