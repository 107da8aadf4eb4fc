"""Toxicity: a linear-chain conditional random field that tags toxic words.

Tokens are words; a chain is a line, cut every CHAIN words.  The labels are of documents,
so token labels are derived: a feature (a word, or its first bytes) that stands in many more
toxic documents than others marks its occurrences in toxic documents as toxic; all other
tokens are clean.  Documents that copy each other count once: they are told apart by a
sketch of their shingles.  The field is fitted to these tags; forward-backward marginals of
whole texts give the offending offsets, and a logistic regression of their sums and maxima
on the document labels gives the score.  Words whose marginal is under FLOOR don't count,
so a text's length alone never does.

The model is fitted on a bounded sample (MAX_TOXIC, MAX_CLEAN, samples.MAX_BYTES).  Its texts
stay with the tasks: the driver gets the features that are chosen, the chains that hold one
as numbers, and the aggregates of each document.  Every document is scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ledgerline.llm.common import releasing, small_batches, stage
from ledgerline.llm.samples import held_out, sampled
from ledgerline.llm.words import ALNUM, Words, mix, words_of
from ledgerline.sources.tables import Tables

CHAIN = 256  # words of a chain at most
PREFIXES = (4, 5, 6, 7, 8)  # bytes
MAX_TOXIC, MAX_CLEAN = 3_000, 6_000  # documents of the fitting sample at most
MIN_DOCUMENTS = 6  # toxic ones with a feature
SKETCHES = 3  # least shingle hashes that tell documents apart
MIN_LOG_ODDS = 1.5  # of a feature, in toxic against other documents, and DEVIATIONS of its standard error less
DEVIATIONS = 1
TAG_LOG_ODDS = 2.0  # from which its words count as toxic in toxic documents
THRESHOLD = 0.3
SPAN = 0.5  # marginal from which a word is part of an offending span
FLOOR = 0.1  # marginal from which a word counts for the score
ROUNDS = 40
TABLE_BITS = 22
ROWS = 512


def features(words: Words, kinds: range = range(1 + len(PREFIXES))) -> np.ndarray:
    """A row of hashes for each kind of feature, a column for each word; 0 is none."""
    size = words.ends - words.starts
    out = np.zeros((len(kinds), len(size)), np.uint64)
    if 0 in kinds:
        out[kinds.index(0)] = words.hashes
    power = np.uint64(0x100000001B3)
    prefix = np.full(len(size), 0xCBF29CE484222325, np.uint64)
    padded = np.concatenate([words.lower, np.zeros(max(PREFIXES), np.uint8)])
    for k in range(PREFIXES[kinds[-1] - 1] if kinds[-1] else 0):
        prefix = (prefix ^ padded[words.starts + k]) * power
        if k + 1 in PREFIXES and 1 + PREFIXES.index(k + 1) in kinds:
            row = kinds.index(1 + PREFIXES.index(k + 1))
            out[row] = np.where(size >= k + 1, mix(prefix + np.uint64(k + 1)), 0)
    return out


@dataclass
class Chains:
    """Words of a group of texts laid out as chains: word i is at (row[i], column[i])."""

    row: np.ndarray
    column: np.ndarray
    lengths: np.ndarray


def chains(words: Words) -> Chains:
    lines = np.flatnonzero(words.lower == 10)
    line = np.searchsorted(lines, words.starts)
    n = len(line)
    new = np.ones(n, bool)
    new[1:] = line[1:] != line[:-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    new |= (np.arange(n) - begin) % CHAIN == 0
    row = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    return Chains(row, np.arange(n) - begin[row] if n else row, np.diff(np.append(begin, n)))


def marginals(odds: np.ndarray, laid: Chains, move: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of each word: the odds of tag 1 by forward-backward; and the sums over the words of
    the pair marginals (a 2 x 2 matrix), each chain counted ``weight`` times.  ``odds`` are
    those of the word alone, ``move[i, j]`` the factor of tag j after tag i.  Chains of like
    length are worked on together."""
    out = np.empty(len(odds))
    pairs = np.zeros((2, 2))
    order = np.argsort(laid.lengths, kind="stable")
    begin = np.cumsum(laid.lengths) - laid.lengths
    (a00, a01), (a10, a11) = move
    at = 0
    while at < len(order):
        shortest = laid.lengths[order[at]]
        stop = np.searchsorted(laid.lengths[order], max(8, shortest * 1.25), "right")
        some = order[at:stop]
        length, steps = laid.lengths[some], laid.lengths[some[-1]]
        index = begin[some] + np.arange(steps)[:, None]  # steps x chains
        inside = np.arange(steps)[:, None] < length
        word = np.where(inside, odds[np.minimum(index, len(odds) - 1)], 1.0)
        ahead, back = np.empty_like(word), np.ones_like(word)
        x = ahead[0] = word[0]
        for t in range(1, steps):
            x = ahead[t] = word[t] * (a01 + x * a11) / (a00 + x * a10)
        for t in range(steps - 2, -1, -1):
            y = word[t + 1] * back[t + 1]
            back[t] = np.where(inside[t + 1], (a10 + a11 * y) / (a00 + a01 * y), 1.0)
        out[index[inside]] = (ahead * back)[inside]
        if weight is not None:
            y = word[1:] * back[1:]
            cells = np.array([np.full_like(y, a00), a01 * y, ahead[:-1] * a10, ahead[:-1] * a11 * y])
            pairs += (cells / cells.sum(0) * inside[1:] * weight[some]).sum((1, 2)).reshape(2, 2)
        at = stop
    return out, pairs


@dataclass
class Field:
    """Features by hash, their weights, and the moves between tags."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    move: np.ndarray  # logarithms

    def __post_init__(self):
        self.hashes = np.append(np.uint64(0), self.hashes)  # number 0 is no feature
        self.weights = np.append(0.0, self.weights)
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def numbers(self, found: np.ndarray) -> np.ndarray:
        """Number of each feature of ``features``, 0 where the field doesn't have it."""
        slot = np.uint64(64 - TABLE_BITS)
        if self._table is None:  # first come of a slot; the others are looked for by search
            self._table = np.zeros(1 << TABLE_BITS, np.int32)
            self._table[(self.hashes[1:] >> slot).astype(np.int64)] = 1
            self._order = np.argsort(self.hashes)
            self._sorted = self.hashes[self._order]
        out = np.zeros(found.shape, np.int32)
        maybe = np.nonzero((self._table[(found >> slot).astype(np.int64)] > 0) & (found > 0))
        at = np.minimum(np.searchsorted(self._sorted, found[maybe]), len(self._sorted) - 1)
        out[maybe] = np.where(self._sorted[at] == found[maybe], self._order[at], 0)
        return out

    def odds(self, numbers: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(self.weights[numbers].sum(0) + self.bias, -30, 30))


def document_keys(words: Words) -> np.ndarray:
    """A number for each document, equal for copies and, mostly, for near copies: of the
    least hashes of its shingles of three words, under SKETCHES orders."""
    h = np.append(words.hashes, np.zeros(2, np.uint64))
    n = len(words.hashes)
    shingle = mix(h[:n] + mix(h[1 : n + 1] + mix(h[2:])))
    out = np.zeros(len(words.first) - 1, np.uint64)
    # shingles within a document; a short document is one shingle of what it has
    last = np.maximum(words.first[1:] - 2, words.first[:-1] + 1)
    some = np.flatnonzero(np.diff(words.first))
    edges = np.ravel(np.column_stack([words.first[:-1][some], last[some]]))
    padded = np.append(shingle, np.uint64(0))
    for k in range(SKETCHES):
        if len(some):
            least = np.minimum.reduceat(mix(padded ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))), edges)[::2]
            out[some] = mix(out[some] + least)
    return out


def documents_with(texts: DataFrame, toxic: int, candidates: np.ndarray | None = None) -> DataFrame:
    """feature, n: the documents (by their key) of this label that hold it.  ``texts`` are
    partitioned by key, so every document is counted by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = 1 + len(PREFIXES)
        seen = [[np.empty((2, 0), np.uint64)] for _ in range(kinds)]
        for words, label, key in _groups(batches):
            owner = np.repeat(np.arange(len(key)), np.diff(words.first))
            here = (label == toxic)[owner]
            context = np.append(np.uint64(0), words.hashes[:-1])[: len(owner)] ^ mix(key)[owner]
            for kind in range(kinds):
                found = features(words, range(kind, kind + 1))[0]
                some = np.flatnonzero(here & (found > 0) & (True if candidates is None else np.isin(found, candidates)))
                seen[kind].append(_distinct(np.stack([found[some], context[some]])))
        for pairs in seen:
            names, n = np.unique(_distinct(np.concatenate(pairs, axis=1))[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"feature": names.view(np.int64), "n": n})

    return texts.mapInArrow(releasing(run), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _distinct(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
    return pairs[:, new]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Words, and label and key of their documents; batches have text, label and key."""
    for batch in batches:
        label, key = batch["label"].to_numpy(), batch["key"].to_numpy().view(np.uint64)
        at = 0
        for n, words in words_of(batch["text"], ALNUM):
            yield words, label[at : at + n], key[at : at + n]
            at += n


def with_keys(rows: DataFrame) -> DataFrame:
    """text, label and key of the sample, partitioned by key and stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = zip(*((document_keys(words).view(np.int64), np.diff(words.first)) for _, words in words_of(batch["text"], ALNUM)))
            columns = [batch["text"], batch["label"], pa.array(np.concatenate(keys)), pa.array(np.concatenate(sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["text", "label", "key", "words"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select("text", F.col("label").cast("long").alias("label")).mapInArrow(releasing(run), "text string, label long, key long, words long")
    return stage(keyed.repartition(parts, "key"), "toxic-sample")


def choose_features(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and log odds of the features that mark toxic documents."""
    words = dict(texts.groupBy("label").agg(F.sum("words")).collect())
    found = documents_with(texts, 1).filter(F.col("n") >= MIN_DOCUMENTS).toArrow()
    names, n = found["feature"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(names)
    names, n = names[order], n[order]
    other = documents_with(texts, 0, names).toArrow() if len(names) else found
    m = np.zeros(len(names))
    m[np.searchsorted(names, other["feature"].to_numpy().view(np.uint64))] = other["n"].to_numpy()
    odds = np.log((n + 0.5) / (words.get(1, 0) + 1)) - np.log((m + 0.5) / (words.get(0, 0) + 1))
    sure = odds - DEVIATIONS * np.sqrt(1 / (n + 0.5) + 1 / (m + 0.5)) >= MIN_LOG_ODDS
    return names[sure], odds[sure]


_PARTS = {"word": np.int32, "number": np.int32, "tags": np.bool_, "row": np.int32, "column": np.int16, "lengths": np.int32, "plain": np.int64}


def chain_data(words: Words, toxic: np.ndarray, field: Field, strong: np.ndarray) -> dict[str, np.ndarray]:
    """What the fit needs of a group of texts: of the chains with a feature, word and number
    of each feature, the tags of the words, their places, and the lengths; chains without
    differ by length alone and are counted.  ``toxic``: of each word, its document's label."""
    numbers, laid = field.numbers(features(words)), chains(words)
    rich = np.zeros(len(laid.lengths), bool)
    rich[laid.row[numbers.any(0)]] = True
    here = rich[laid.row]
    numbers = numbers[:, here]
    parts = {
        "word": np.nonzero(numbers.T)[0], "number": numbers.T[numbers.T > 0],
        "tags": toxic[here] & (strong[numbers].max(0) >= TAG_LOG_ODDS), "row": (np.cumsum(rich) - 1)[laid.row[here]],
        "column": laid.column[here], "lengths": laid.lengths[rich], "plain": np.bincount(laid.lengths[~rich], minlength=CHAIN + 1),
    }
    return {name: parts[name].astype(kind) for name, kind in _PARTS.items()}


def fit_field(texts: DataFrame, rounds: int = ROUNDS) -> Field:
    """The field of the rows of ``with_keys``."""
    hashes, log_odds = choose_features(texts)
    field = Field(hashes, np.zeros(len(hashes)), -4.0, np.zeros((2, 2)))
    if not len(hashes):
        return field
    strong = np.append(0.0, log_odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, label, _ in _groups(batches):
            parts = chain_data(words, np.repeat(label == 1, np.diff(words.first)), field, strong)
            yield pa.RecordBatch.from_pydict({name: [x.tobytes()] for name, x in parts.items()})

    held = texts.mapInArrow(releasing(run), ", ".join(f"{name} binary" for name in _PARTS)).toArrow().to_pylist()
    return fit_chains(field, [{name: np.frombuffer(row[name], kind) for name, kind in _PARTS.items()} for row in held], rounds)


def fit_chains(field: Field, groups: list[dict[str, np.ndarray]], rounds: int = ROUNDS) -> Field:
    """``field`` with the weights and moves that fit the groups of ``chain_data``."""
    n = len(field.weights)
    data = [(g["word"], g["number"], g["tags"], Chains(g["row"], g["column"], g["lengths"]), np.ones(len(g["lengths"]))) for g in groups]
    plain = sum((g["plain"] for g in groups), np.zeros(CHAIN + 1))
    lengths = np.flatnonzero(plain)
    row = np.repeat(np.arange(len(lengths)), lengths)
    none = np.empty(0, np.int64)
    data.append((none, none, np.zeros(len(row), bool), Chains(row, row, lengths), plain[lengths]))
    # what the tags have of each parameter: features, the bias, and the four moves
    seen = np.zeros(n + 5)
    for word, number, tags, laid, weight in data:
        joined = np.flatnonzero(laid.row[1:] == laid.row[:-1])
        np.add.at(seen, n + 1 + 2 * tags[:-1][joined] + tags[1:][joined], weight[laid.row[joined]])
        seen[-5] += tags.sum()
        seen[:-5] += np.bincount(number, tags[word], n)
    # steps against the gradient, with momentum and a scale of its own for each parameter
    value = np.concatenate([field.weights, [field.bias], field.move.ravel()])
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, rounds + 1):
        field.weights, field.bias, field.move = value[:-5], value[-5], value[-4:].reshape(2, 2)
        slope = 0.1 * value - seen
        for word, number, tags, laid, weight in data:
            sums = np.bincount(word, field.weights[number], len(tags)) + field.bias
            odds, pairs = marginals(np.exp(np.clip(sums, -30, 30)), laid, np.exp(field.move), weight)
            chance = odds / (1 + odds)
            slope[-4:] += pairs.ravel()
            slope[-5] += chance @ weight[laid.row]
            slope[:-5] += np.bincount(number, chance[word], n)
        slope[0] = 0
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        value = value - 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    field.weights, field.bias, field.move = value[:-5], value[-5], value[-4:].reshape(2, 2)
    return field


@dataclass
class Model:
    field: Field
    weights: np.ndarray  # of document_features

    def tag(self, words: Words) -> np.ndarray:
        """The marginal of each word."""
        odds, _ = marginals(self.field.odds(self.field.numbers(features(words))), chains(words), np.exp(self.field.move))
        return odds / (1 + odds)

    def score(self, words: Words, tagged: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(document_features(words, tagged) @ self.weights, -30, 30)))


def document_features(words: Words, tagged: np.ndarray) -> np.ndarray:
    """Of each document: 1, and aggregates of the marginals of at least FLOOR."""
    counted = np.where(tagged >= FLOOR, tagged, 0.0)
    sums = np.append(0.0, np.cumsum(counted))
    n = np.diff(words.first)
    total = np.maximum(sums[words.first[1:]] - sums[words.first[:-1]], 0.0)
    high = np.zeros(len(n))
    some = np.flatnonzero(n)
    if len(some):
        high[some] = np.maximum.reduceat(counted, words.first[:-1][some])
    return np.stack([np.ones(len(n)), np.log1p(total), high, np.sqrt(total)], axis=1)


def fit_scores(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a little shrinkage."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(curve, slope), -3, 3)
    return w



def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the sample of ``samples.sampled``, which leaves out the documents whose
    crc32(doc_id) mod 4 is 2, takes one row of each id and the beginning of very long texts;
    a label without any document to fit on is an error.  Without a toxic and a clean document
    there is nothing to learn, and every document scores 0.  Where no feature tells the
    labels apart, every document scores the share of toxic ones among the labels."""
    sample, size = sampled(docs, labels, "toxic", {0: MAX_CLEAN, 1: MAX_TOXIC})
    texts = with_keys(sample)
    taken = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = Field(np.empty(0, np.uint64), np.empty(0), -30.0, np.zeros((2, 2)))
    if len(taken) < 2:
        return Model(nothing, np.array([-1e3, 0, 0, 0]))
    model = Model(fit_field(texts), np.zeros(4))
    if len(model.field.hashes) == 1:  # number 0 alone
        return Model(nothing, np.array([np.log(size[1] / size[0]), 0, 0, 0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, label, _ in _groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(label), *map(pa.array, document_features(words, model.tag(words)).T)], names=list("labcd"))

    found = texts.mapInArrow(releasing(run), "l long, a double, b double, c double, d double").toArrow()
    toxic = found["l"].to_numpy() == 1
    x = np.column_stack([found[c].to_numpy() for c in "abcd"])
    weight = np.where(toxic, size[1] / taken[1], size[0] / taken[0])  # back to their share among all labels
    return Model(model.field, fit_scores(x, toxic.astype(float), weight / weight.mean()))


def _spans(words: Words, tagged: np.ndarray) -> list[list[int]]:
    """Of each document, starts and ends of runs of tagged words, in code points."""
    out: list[list[int]] = [[] for _ in words.at[1:]]
    hot = np.flatnonzero(tagged >= SPAN)
    if len(hot):
        points = np.append(0, np.cumsum(words.lower & 0xC0 != 0x80))
        document = np.searchsorted(words.first, hot, "right") - 1
        before = -2
        for i, d in zip(hot.tolist(), document.tolist()):
            start, end = (int(points[x[i]] - points[words.at[d]]) for x in (words.starts, words.ends))
            if i == before + 1 and out[d]:
                out[d][-1] = end
            else:
                out[d] += [start, end]
            before = i
    return out


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """One row per document: doc (a struct of the ``keep`` columns, by default doc_id),
    score (0 to 1), spans (flat starts and ends of the offending runs of words, in code
    points).  Null and empty texts have the score of a text without words."""
    keep = keep or ["doc_id"]
    inside = text_col in keep  # then the text is sent once, within the struct
    rows = docs.select(F.struct(*keep).alias("doc"), *([] if inside else [F.col(text_col).alias("text")]))
    schema = StructType([rows.schema["doc"], StructField("score", DoubleType()), StructField("spans", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            scores, spans = [], []
            for _, words in words_of(batch["doc"].field(text_col) if inside else batch["text"], ALNUM):
                tagged = model.tag(words)
                scores.append(model.score(words, tagged))
                spans += _spans(words, tagged)
            columns = [batch["doc"], pa.array(np.concatenate(scores)), pa.array(spans, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "score", "spans"])

    return small_batches(rows).mapInArrow(releasing(run), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below THRESHOLD, with their columns; all of them where no
    feature tells toxic ones from others."""
    model = learn(docs, labels)
    if len(model.field.hashes) == 1:
        return docs
    return score(docs, model, keep=docs.columns).filter(F.col("score") < THRESHOLD).select("doc.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    docs = tables["documents"]
    return score(docs, learn(docs, tables["labels"])).select(
        F.col("doc.doc_id").alias("doc_id"), held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
