import random
import re

import pytest

from ledgerline.llm import decontaminate
from ledgerline.llm.decontaminate import WuManber, drop_contaminated, find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(k) for k in windows}:
            for a in range(len(w) - m + 1):
                if owners := windows.get(tuple(w[a : a + m])):
                    hit.update(range(a, a + m))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def run(spark, docs, items, make_docs, window=10):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = find_contamination(make_docs(docs), bench, window).collect()
    return sorted(((r.doc.doc_id, r.n_words, sum(r.ranges[1::2]) - sum(r.ranges[::2]), list(r.items)) for r in rows), key=repr)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "é", "É", "x1", "the", "of", "zz", "中"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, text(rng.randint(0, 14))) for k in range(12)] + [(3, text(12)), (None, "the the the"), (20, None), (21, "--")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    docs += [(100 + k, f"{text(5)}{t or ''} {text(5)}") for k, (_, t) in enumerate(items)] + [(None, None), (7, ""), (7, items[0][1])]
    return docs, items


@pytest.mark.parametrize("window", [3, 10])
def test_matches_brute_force(spark, make_docs, window):
    docs, items = case(window)
    assert run(spark, docs, items, make_docs, window) == brute(docs, items, window)


def test_benchmark_in_blocks_gives_the_same(spark, make_docs, monkeypatch):
    docs, items = case(5)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert run(spark, docs, items, make_docs, 4) == brute(docs, items, 4)


def test_very_long_text_and_empty_tables(spark, make_docs):
    docs = [(1, "one two three four five " * 300_000 + "six seven"), (2, "five six")]
    assert run(spark, docs, [(1, "Four, five; SIX seven")], make_docs, 3) == [(1, 1_500_002, 4, ["1"]), (2, 2, 0, [])]
    assert run(spark, [], [(1, "a")], make_docs) == []
    assert run(spark, [(1, "a")], [], make_docs) == [(1, 1, 0, [])]


def test_search_skips_and_finds_all():
    rng = random.Random(2)
    import numpy as np

    for _ in range(300):
        m = rng.randint(1, 5)
        patterns = sorted({tuple(rng.randint(1, 3) for _ in range(m)) for _ in range(rng.randint(1, 6))})
        text = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        got = sorted(WuManber(m, patterns).search(np.array(text, np.int64)))
        assert got == sorted((i, n) for n, p in enumerate(patterns) for i in range(len(text) - m + 1) if tuple(text[i : i + m]) == p)


def test_pipeline_stage_keeps_clean_documents_with_their_columns(spark, make_docs):
    docs = make_docs([(1, "one two three"), (2, "clean"), (3, None)])
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
