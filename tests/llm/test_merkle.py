from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle


def digest(*inputs):
    return sha256("".join(inputs).encode()).hexdigest()


def leaf_of(*fields):
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def fold(level, i, new):
    """Root and siblings of a list of digests whose i-th is replaced by ``new``."""
    proof = []
    while len(level) > 1:
        run = range(i - i % 3, min(i - i % 3 + 3, len(level)))
        proof += [level[k] for k in run if k != i]
        new = digest(*(new if k == i else level[k] for k in run))
        level = [digest(*level[k : k + 3]) for k in range(0, len(level), 3)]
        i //= 3
    return new, proof


def brute(rows, change):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        key = ("0" if r[1] is None else "1" + r[1]).encode()
        trees.setdefault(key, []).append((r[0] is not None, r[0] or 0, leaf_of(*r), leaf_of(*r[:4], change(r[4]))))
    names = sorted(trees)
    levels = [[x[2] for x in sorted(trees[k])] for k in names]
    subroots = [fold(level, 0, level[0])[0] for level in levels]
    root = fold(subroots, 0, subroots[0])[0] if subroots else None
    out = []
    for s, (name, level) in enumerate(zip(names, levels)):
        for i, (known, doc_id, leaf, changed) in enumerate(sorted(trees[name])):
            sub, inner = fold(level, i, changed)
            top, outer = fold(subroots, s, sub)
            out.append((doc_id if known else None, leaf, subroots[s], root, "".join(inner + outer), top))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, n long, leaf string, nodes long"
CLASH = ("x", 1, 2, "y", 3)


def run(spark, rows, levels=merkle.LEVELS):
    docs = spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)
    found = merkle.manifest(docs, F.replace("text", F.lit("\n"), F.lit("")), levels=levels).collect()
    return sorted(((r.doc_id, *(bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof", "folded"))) for r in found), key=repr), found


def rows_of(n):
    sources = ["a", "é", None, "", "hot", "hot", "hot", "B"]
    return [(i if i % 11 else None, sources[i % 8], "en" if i % 3 else None, i % 5 or None, None if i % 7 == 0 else f"line {i % 9}\nnext") for i in range(n)]


@pytest.mark.parametrize("levels,n", [(merkle.LEVELS, 150), (1, 150), (2, 90)])
def test_every_column_against_brute_force(spark, levels, n):
    rows = rows_of(n) + [(1, "alone", None, 0, ""), (5, "hot", "en", 1, "same"), (5, "hot", "en", 1, "same"), (9, "long", "de", 7, "w\n" * 300_000)]
    got, _ = run(spark, rows, levels)
    assert got == brute(rows, lambda t: t and t.replace("\n", ""))


def test_one_source_and_no_rows(spark):
    rows = [(i, "s", "l", 1, f"a{i}\n") for i in range(10)]
    got, found = run(spark, rows)
    assert got == brute(rows, lambda t: t.replace("\n", ""))
    assert all(r.root == r.subroot and r.folded != r.root for r in found)
    assert run(spark, [])[0] == []
    assert run(spark, [(None, None, None, None, None)])[0] == brute([(None,) * 5], lambda t: t)


def test_a_version_has_only_the_ancestors_of_its_leaf(spark):
    """10 leaves make 3 levels; every version has 3 nodes of its own, the last is its root."""
    docs = spark.createDataFrame([(i, "s", "l", 1, f"a{i}\n", *CLASH) for i in range(10)], SCHEMA)
    for r in merkle.manifest(docs, F.lit("changed")).collect():
        assert len(r.copied) == 3 * 32 and r.copied[-32:] == r.folded
    for r in merkle.manifest(docs).collect():
        assert r.copied[-32:] == r.root == r.folded
