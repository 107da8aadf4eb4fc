import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import quality, samples, toxicity
from ledgerline.llm.words import ALNUM, words_of
from tests.conftest import SF_CHECK


def held_out_accuracy(spark, rows, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    pairs = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    return pairs, sum(a == b for a, b in pairs) / len(pairs)


def test_toxicity_on_held_out_documents(spark):
    rows = toxicity.op7_toxicity(spark, SF_CHECK).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows) and len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    pairs, accuracy = held_out_accuracy(spark, rows, "toxic")
    assert accuracy >= 0.95 and sum(p for a, p in pairs if a) >= 0.75 * sum(a for a, _ in pairs)


def test_quality_on_held_out_documents(spark):
    rows = quality.op8_quality(spark, SF_CHECK).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    _, accuracy = held_out_accuracy(spark, rows, "quality")
    assert accuracy >= 0.95


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 3, 6])
    row = np.repeat(np.arange(4), lengths)
    laid = toxicity.Chains(row, row, lengths)
    odds, move = np.exp(rng.normal(size=14)), np.exp(rng.normal(size=(2, 2)))
    got, pairs = toxicity.marginals(odds, laid, move, np.array([1.0, 2, 1, 1]))
    want, counted, at = np.empty(14), np.zeros((2, 2)), 0
    for n, weight in zip(lengths, (1, 2, 1, 1)):
        total, ones, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            tags = [(code >> k) & 1 for k in range(n)]
            p = np.prod([odds[at + k] for k in range(n) if tags[k]]) * np.prod([move[a, b] for a, b in zip(tags, tags[1:])])
            total += p
            ones += p * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                moves[a, b] += p
        want[at : at + n] = ones / (total - ones)
        counted += weight * moves / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, counted)


def toy(spark, make_docs):
    texts = [f"word{i % 13} some text {'you vile gromp ' if i % 4 == 0 else 'fine day '} number{i} end" for i in range(400)]
    docs = make_docs([*enumerate(texts), (1000, None), (1001, ""), (None, "vile gromp"), (3, texts[3]), (1002, "x " * 200_000 + "you vile gromp")])
    labels = spark.createDataFrame([(i, 1 - int(i % 4 == 0), int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (399, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_spans_scores_and_odd_rows(spark, make_docs):
    docs, labels = toy(spark, make_docs)
    rows = toxicity.score(docs, toxicity.learn(docs, labels), keep=["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        toxic = "gromp" in (r.doc.text or "")
        assert (r.score >= 0.3) == toxic, r.doc.doc_id
        found = [r.doc.text[a:b] for a, b in zip(r.spans[::2], r.spans[1::2])]
        assert any("gromp" in x for x in found) == toxic


def test_pipeline_stage_keeps_clean_rows_and_columns(spark, make_docs):
    docs, labels = toy(spark, make_docs)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(repr(r.text) for r in kept.collect()) == sorted(repr(r.text) for r in docs.collect() if "gromp" not in (r.text or ""))


def test_nothing_to_learn(spark, make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()} == {0.0} or all(
        r.score < 1e-9 for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()
    )
    assert quality.learn(docs, none) is None
    assert {(r.tail, r.tails) for r in quality.rate(docs, None).collect()} == {(None, None)}
    assert quality.select_good(docs, none).count() == 2
    empty = make_docs([])
    assert toxicity.drop_toxic(empty, none).collect() == []


def test_three_grades_are_ordered():
    rng = np.random.default_rng(3)
    marks = {0: "!!", 1: "ok", 2: "fine"}
    rating = rng.integers(0, 3, 600)
    texts = [" ".join(rng.choice(["a", "b", "c", marks[g]], 30)) for g in rating.tolist()]
    groups = list(quality.texts_with_capitals(pa.array(texts)))
    model = quality.fit(groups, rating, np.ones(600))
    assert model.thresholds[0] < model.thresholds[1]
    chances = np.concatenate([model.chances(model.position(w, raw)) for _, w, raw in groups])
    assert (chances[:, 0] >= chances[:, 1]).all()
    expected = chances.sum(1)
    assert (np.round(expected) == rating).mean() > 0.95


def test_features_do_not_depend_on_the_neighbours_in_a_batch():
    texts = ["One two", "", None, "THREE!! two two", "é É"]
    together = [f for _, w, raw in quality.texts_with_capitals(pa.array(texts)) for f in [quality.features(w, raw)]][0]
    first = next(iter(words_of(pa.array(texts), quality.NOT_SPACE)))[1].first
    for k, t in enumerate(texts):
        alone = [quality.features(w, raw) for _, w, raw in quality.texts_with_capitals(pa.array([t], pa.string()))][0]
        assert (alone[0] == together[0][:, first[k] : first[k + 1]]).all() and alone[1][0] == together[1][k]


def test_a_rating_scale_must_be_short(spark, make_docs):
    labels = spark.createDataFrame([(i, i) for i in range(100)], "doc_id long, quality int")
    with pytest.raises(ValueError):
        quality.learn(make_docs([(1, "a")]), labels)


def test_words_are_the_patterns_words():
    import re

    texts = ["Don't stop-2 É中 x\x7fy", "", "word " * 50_000, "z" * 3_000_000, None]
    got = [[w.lower[a:b].tobytes() for a, b in zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]])] for n, w in words_of(pa.array(texts), ALNUM) for i in range(n)]
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert got == [[x.encode() for x in find((t or "").translate(lower))] for t in texts]


RUDE = ["gromp", "snarv", "blick", "drofe", "plung", "twerb"]


def rare_toxic(spark, make_docs):
    """4,000 documents of 100 bytes, 4% of them toxic."""
    rude = {i: RUDE[i // 25 % len(RUDE)] for i in range(0, 4000, 25)}
    docs = make_docs([(i, f"w{i % 97} says x{i % 89} {rude.get(i, 'fine')} to y{i % 83} ".ljust(100, "z")) for i in range(4000)])
    return docs, spark.createDataFrame([(i, int(i in rude), int(i not in rude)) for i in range(4000)], "doc_id long, toxic int, quality int"), rude


@pytest.mark.parametrize("column", ["toxic", "quality"])
def test_the_byte_bound_leaves_the_rare_label_its_share(spark, make_docs, monkeypatch, column):
    monkeypatch.setattr(samples, "MAX_BYTES", 40_000)
    docs, labels, rude = rare_toxic(spark, make_docs)
    sample, size = samples.labelled_sample(docs, labels, column, {0: 2000, 1: 2000})
    got = sample["label"].to_pylist()
    rare = 1 if column == "toxic" else 0
    assert got.count(rare) == size[rare] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in rude)
    assert got.count(1 - rare) == 400 - size[rare]


def test_held_out_recall_where_the_byte_bound_binds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(samples, "MAX_BYTES", 40_000)
    docs, labels, rude = rare_toxic(spark, make_docs)
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc.doc_id).encode()) % 4 == 2]
    assert [r.doc.doc_id for r in held if (r.score >= toxicity.THRESHOLD) != (r.doc.doc_id in rude)] == []


def test_shares_of_the_byte_bound():
    assert samples.shares({0: 5, 1: 100, 2: 100}, {0: 9, 1: 9, 2: 9}, 60) == {0: 20, 1: 27, 2: 28}
    assert samples.shares({0: 500, 1: 500}, {0: 60, 1: 30}, 90) == {0: 60, 1: 30}
    assert samples.shares({0: 50, 1: 1}, {0: 2, 1: 2}, 1000) == {1: 500, 0: 999} and samples.shares({}, {}, 10) == {}


def test_a_label_without_any_text_is_an_error(spark, make_docs):
    docs = make_docs([(i, f"fine words {i}") for i in range(50)])
    labels = spark.createDataFrame([(i, 1, int(i >= 1000)) for i in [*range(50), *range(1000, 1020)]], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError, match="no text to fit on"):
        toxicity.learn(docs, labels)
    toxicity.learn(make_docs([]), labels)


def quality_corpus(n=90):
    rng = np.random.default_rng(8)
    rating = rng.integers(0, 3, n)
    texts = [" ".join(rng.choice(["a", "b", "!!", ["bad", "ok", "Fine"][g]], rng.integers(5, 25))) for g in rating.tolist()]
    return texts, rating, rng.uniform(0.5, 2.0, n)


def test_ordinal_fit_reaches_a_minimum_found_without_its_gradient():
    """The cumulative-link loss is written out from its definition: at the fit its numerical
    slope is about nothing, and no step along any parameter lowers it by much."""
    texts, rating, weight = quality_corpus()
    groups = list(quality.texts_with_capitals(pa.array(texts)))
    model = quality.fit(groups, rating, weight, rounds=600)
    x = np.zeros((len(texts), 1 << quality.BITS))
    at = 0
    for n, words, raw in groups:
        rows, length = quality.features(words, raw)
        size = np.diff(words.first)
        for d in range(n):
            x[at + d, length[d]] += 1
            for row in rows:
                np.add.at(x[at + d], row[words.first[d] : words.first[d + 1]], 1 / size[d])
        at += n
    used = np.flatnonzero(x.any(0))
    x = x[:, used]

    def loss(w, thresholds):
        """Minus the log-likelihood, and the penalty of the fit's own parameters."""
        cut = 1 / (1 + np.exp(-(np.asarray(thresholds)[None] - (x @ w)[:, None])))
        edges = np.concatenate([np.zeros((len(x), 1)), cut, np.ones((len(x), 1))], axis=1)
        chance = edges[np.arange(len(x)), rating + 1] - edges[np.arange(len(x)), rating]
        return -(weight * np.log(chance)).sum() + 0.5 * 1e-2 * (w**2).sum()

    w, thresholds = model.weights[used], model.thresholds
    here = loss(w, thresholds)
    assert here < 0.5 * loss(np.zeros_like(w), thresholds)
    for k in range(len(w) + 2):
        def moved(by, k=k):
            return loss(w + by * (np.arange(len(w)) == k), thresholds) if k < len(w) else loss(w, thresholds + by * (np.arange(2) == k - len(w)))

        slope = (moved(1e-4) - moved(-1e-4)) / 2e-4  # numerical
        assert abs(slope) < 0.02 * weight.sum(), (k, slope)
        assert min(moved(0.3), moved(-0.3)) > here - 0.01 * here


def test_chances_are_those_of_the_definition():
    texts, rating, weight = quality_corpus(40)
    groups = list(quality.texts_with_capitals(pa.array(texts)))
    model = quality.fit(groups, rating, weight, rounds=50)
    for n, words, raw in groups:
        position = model.position(words, raw)
        got = model.chances(position)
        want = [[1 - 1 / (1 + np.exp(-(t - p))) for t in model.thresholds] for p in position]
        assert np.allclose(got, want)


# ------------------------------------------------------------------ toxicity, by hand
def small_field(texts, hot):
    """A field whose features are the words ``hot`` with given weights."""
    [(n, words)] = list(words_of(pa.array(texts), ALNUM))
    [(_, marks)] = list(words_of(pa.array([" ".join(hot)]), ALNUM))
    field = toxicity.Field(marks.hashes, np.array(list(hot.values()), float), -2.0, np.array([[0.3, -0.4], [-0.2, 0.9]]))
    return words, field


def test_tags_scores_and_spans_against_all_tag_sequences():
    texts = ["vile gromp here\nfine line", "é gromp", "", "clean words only", "gromp vile gromp"]
    hot = {"gromp": 3.0, "vile": 1.2}
    words, field = small_field(texts, hot)
    model = toxicity.Model(field, np.array([-3.0, 1.0, 4.0, 0.5]))
    tagged = model.tag(words)
    got, at = [], 0
    for text in texts:
        found, spans, end = [], [], 0
        for line in text.split("\n"):
            tokens = line.split()
            alone = np.array([np.exp(hot.get(t, 0.0) - 2.0) for t in tokens])
            total, ones = 0.0, np.zeros(len(tokens))
            for code in range(2 ** len(tokens)):
                tags = [code >> k & 1 for k in range(len(tokens))]
                p = np.prod([a for a, t in zip(alone, tags) if t]) * np.exp(sum(field.move[a, b] for a, b in zip(tags, tags[1:])))
                total += p
                ones += p * np.array(tags)
            found += (ones / total).tolist() if tokens else []
        assert np.allclose(tagged[at : at + len(found)], found)
        for k, t in enumerate(text.split()):
            start = text.index(t, end)
            if found[k] >= toxicity.SPAN:
                if spans and k and found[k - 1] >= toxicity.SPAN:
                    spans[-1] = start + len(t)
                else:
                    spans += [start, start + len(t)]
            end = start + len(t)
        counted = [p for p in found if p >= toxicity.FLOOR]
        logit = -3.0 + np.log1p(sum(counted)) + 4.0 * max(counted, default=0.0) + 0.5 * np.sqrt(sum(counted))
        got.append((1 / (1 + np.exp(-logit)), spans))
        at += len(found)
    assert np.allclose(model.score(words, tagged), [s for s, _ in got])
    assert toxicity._spans(words, tagged) == [s for _, s in got]


def test_a_toxic_word_with_one_neighbour_and_long_clean_texts(spark, make_docs):
    """The word always follows the same word; a clean text's length never makes it toxic."""
    texts = [f"w{i % 37} x{i % 31} {'so gromp' if i % 5 == 0 else 'so fine'} y{i % 29} z{i}" for i in range(600)]
    docs = make_docs([*enumerate(texts), (5000, " ".join(f"w{i % 37} x{i % 31} so fine" for i in range(50_000))), (5001, "so gromp")])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    rows = {r.doc.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels), keep=["doc_id", "text"]).collect()}
    assert rows[5000].score < 0.3 and not rows[5000].spans
    assert rows[5001].score >= 0.3 and rows[5001].doc.text[rows[5001].spans[0] : rows[5001].spans[1]].endswith("gromp")


def test_labels_without_any_telling_word_score_their_share(spark, make_docs):
    docs = make_docs([(i, f"same words in every text {i % 7}") for i in range(200)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    scores = {round(r.score, 6) for r in toxicity.score(docs, model).collect()}
    fitted = [i % 4 == 0 for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert scores == {round(sum(fitted) / len(fitted), 6)}
    assert toxicity.drop_toxic(docs, labels).count() == 200


def test_very_long_texts_and_repeated_ids_are_fitted_on_once(spark, make_docs):
    long = "gromp " * 60_000  # over MAX_DOCUMENT bytes
    docs = make_docs([(0, long), *[(1, "fine words")] * 50, (4, "more fine words")])
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 0)], "doc_id long, toxic int")
    sample, size = samples.labelled_sample(docs, labels, "toxic", {0: 10, 1: 10})
    assert sorted(sample["label"].to_pylist()) == sorted(int(i == 0) for i in (0, 1, 4) if zlib.crc32(str(i).encode()) % 4 != 2)
    assert max(len(t) for t in sample["text"].to_pylist()) <= samples.MAX_DOCUMENT // 4
