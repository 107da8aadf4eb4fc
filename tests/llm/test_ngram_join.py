import random
import re
from collections import defaultdict
from itertools import combinations

import pytest

from ledgerline.llm import ngram_join
from ledgerline.llm.ngram_join import group_near_copies, keep_one

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(range(len(pairs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(pairs):
        if i is not None and sets[k]:
            least[find(k)] = i if least[find(k)] is None else min(i, least[find(k)])
    return sorted(((i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(pairs)), key=repr)


def run(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in group_near_copies(docs).collect()), key=repr)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, families, size):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    pairs, n = [], 0
    for f in range(families):
        words = [f"f{f}w{i}" for i in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, size)):
            text = edited(rng, words, rng.randint(0, max(1, len(words) // 25)))
            if rng.random() < 0.2:
                text += " " + passage
            pairs.append((n, text))
            n += 1
    pairs += [(n + k, passage) for k in range(3)] + [(n + 9, "Short text"), (n + 8, "short  TEXT"), (n + 7, "a b c d e"), (n + 6, "a b c d f")]
    rng.shuffle(pairs)
    return pairs


def test_matches_brute_force_with_odd_rows(make_docs):
    pairs = corpus(1, 25, 8)
    pairs += [(900, None), (901, ""), (902, " \n"), (None, "x y z u v w"), (None, "x y z u v w"), (950, "x y z u v w"), (None, "alone in the whole wide world"), (5, pairs[0][1]), (5, pairs[0][1])]
    assert run(make_docs(pairs)) == brute(pairs)


def test_large_blocks_are_searched_in_chunks(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 300)
    pairs = corpus(2, 4, 60)
    assert run(make_docs(pairs)) == brute(pairs)


def test_one_third_near_copies_and_a_chain(make_docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    pairs = [(i, edited(rng, words, rng.randint(0, 3))) for i in range(100)]
    pairs += [(100 + i, " ".join(f"d{i}x{j}" for j in range(30))) for i in range(150)]
    pairs += [(300 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60))) for i in range(20)]  # each near the next
    assert run(make_docs(pairs)) == brute(pairs)


def test_the_bound_itself_is_a_link(make_docs):
    base = [f"w{i}" for i in range(12)]  # 8 shingles; with 2 more words 10: 8 of 10
    pairs = [(1, " ".join(base)), (2, " ".join([*base, "y", "z"])), (3, " ".join([*base, "q", "r", "s"]))]
    assert run(make_docs(pairs)) == brute(pairs)
    assert dict((i, c) for i, _, c in run(make_docs(pairs)))[2] == 1


def test_empty_table_and_very_long_text(make_docs):
    assert run(make_docs([])) == []
    words = [f"w{i}" for i in range(200_000)]
    pairs = [(1, " ".join(words)), (2, " ".join(words[:-10])), (3, " ".join(words[:100_000]))]
    assert run(make_docs(pairs)) == [(1, 199_996, 1), (2, 199_986, 1), (3, 99_996, 3)]


def test_one_document_of_each_group_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make_docs([(4, text), (2, text + " more"), (9, text), (2, text + " more"), (7, None), (8, ""), (None, text), (6, "other words altogether")])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 6, 7, 8]


def test_components_of_long_paths(spark):
    from ledgerline.llm.components import connected

    edges = [(i, f"e{i}") for i in range(199)] + [(i + 1, f"e{i}") for i in range(199)] + [(1000, "x"), (1001, "x")]
    got = {r.item: r.label for r in connected(spark.createDataFrame(edges, "item long, group string")).collect()}
    assert got == {**{i: 0 for i in range(200)}, 1000: 1000, 1001: 1000}
    assert connected(spark.createDataFrame([], "item long, group string")).collect() == []


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 11, 100])
def test_required_overlap_is_the_least_that_can_link(n):
    need = ngram_join.required(n)
    assert ngram_join.is_link(need, n, need) and not ngram_join.is_link(need - 1, n, need - 1)
