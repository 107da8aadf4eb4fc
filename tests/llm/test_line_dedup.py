import hashlib
import random
from collections import defaultdict

from ledgerline.llm.line_dedup import apply_bitmaps, drop_bitmaps, drop_shared_lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, min_docs):
    seen = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if line.strip(SPACE):
                seen[line.strip(SPACE).translate(LOWER)].add((i, t))
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(seen[x.strip(SPACE).translate(LOWER)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(docs, min_docs):
    out = apply_bitmaps(docs, drop_bitmaps(docs, min_docs))
    return sorted(((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()), key=repr)


def test_matches_brute_force(make_docs):
    rng = random.Random(3)
    lines = ["Menu", " menu\t", "MENÜ", "menÜ", "", " ", "É", "é", *[f"own {i}" for i in range(40)]]
    pairs = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 12)))) for i in range(120)]
    pairs += [(500, None), (501, ""), (502, "\n\n"), (503, "menu\r"), (504, " menu")]
    assert run(make_docs(pairs), 5) == brute(pairs, 5)


def test_repeated_rows_are_one_document_and_null_ids_count(make_docs):
    pairs = [(1, "x\ny")] * 4 + [(None, "x\nz"), (None, "x\nq")]
    assert run(make_docs(pairs), 3) == brute(pairs, 3)
    assert run(make_docs(pairs), 4) == brute(pairs, 4)


def test_long_document_uses_many_bitmap_words(make_docs):
    text = "\n".join("shared" if i % 7 == 0 else f"l{i}" for i in range(3000))
    pairs = [(i, text.replace("l1\n", f"l1-{i}\n", 1)) for i in range(3)] + [(9, "shared")]
    assert run(make_docs(pairs), 4) == brute(pairs, 4)


def test_hot_line(make_docs):
    pairs = [(i, f"{'hot' if i % 3 == 0 else i}\nown {i}") for i in range(1500)]
    assert run(make_docs(pairs), 10) == brute(pairs, 10)


def test_empty_table_and_columns_of_the_pipeline_stage(spark, make_docs):
    assert run(make_docs([]), 2) == []
    docs = spark.createDataFrame([(1, "a\nb", 3), (2, "a\nc", 3), (3, None, 0)], "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, drop_shared_lines(docs, 2).collect()))
    assert got == [(1, "b", 1), (2, "c", 1), (3, None, 0)]


def test_no_python_in_the_plan(make_docs):
    docs = make_docs([(1, "a")])
    plan = apply_bitmaps(docs, drop_bitmaps(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_hash(spark):
    from ledgerline.llm.line_dedup import op3_line_dedup
    from tests.conftest import SF_SMALL

    rows = op3_line_dedup(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    whole = [r for r in rows if r.n_dropped == 0]
    assert whole and all(r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in whole)
