"""Personal data: rule spans, and spans that boosted trees add.  DataFrame functions only.

Four strict rules find the base spans (email, ip, card, phone).  High-recall generators
propose further, overlapping spans of the same kinds; gradient boosted trees score them by
the shape of the span and the characters around it, and a threshold for each kind,
calibrated on held-out candidates, selects the ones that are added.

There are no span labels, so the trees learn from the rules: a candidate is a positive
when a base span of its kind covers or crosses it, and unknown otherwise.  The features leave out what only the
rules see (the plus sign, the exact separators), so that a candidate scoring as high as
the confirmed ones is one that looks like them and stands where they stand.

A text is matched by ``split`` and ``regexp_extract_all`` of one pattern; a window over the
matches of a document sums the lengths up to offsets in code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stage
from ledgerline.sources.tables import Tables

KINDS = ("email", "ip", "card", "phone")

# The rules, written so that the matcher never goes back: what follows a possessive run
# cannot be part of it, and a match never starts inside a run of its first class other than
# where the match before ended, as a match from the start of the run would come first.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# High-recall patterns of the generators, by kind.
GENERATORS = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}\s?(?:@|[(\[]at[)\]])\s?[A-Z0-9-]{1,63}(?:\s?(?:\.|[(\[]dot[)\]])\s?[A-Z0-9-]{1,63}){1,4}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\s?[.,]\s?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])",
}

# A text without any of these has no match of any pattern.
MAY_MATCH = r"(?i)@|[(\[]at[)\]]|[0-9][^A-Za-z]*[0-9]"

MAX_FIT = 8_000  # candidates the trees are fitted on, an equal part of each kind and label, by hash order
PRECISION = 0.99  # estimated, of the held-out candidates at or above a kind's threshold
BINS = 1000  # of the scores of held-out candidates
CONTEXT = 16  # characters kept on either side


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits; digits are at most 19 where this is asked."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    """What a match of a rule must fulfil besides its pattern."""
    n = F.length(_digits(hit))
    small = F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(n.between(12, 19), _luhn(_digits(hit))).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def _matches(kind: str, pattern: str, generated: bool) -> Column:
    """Array of the matches in order, with the length of the gap before each and context."""
    hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    gaps = F.split("text", pattern)
    return F.transform(
        F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"), F.slice(gaps, 2, F.size(hits)).alias("after")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(generated).alias("generated"), i.alias("i"),
            x["hit"].alias("hit"), F.length(x["gap"]).cast("long").alias("gap"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["after"], F.lit(CONTEXT)).alias("after"),
        ),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, row (a number of the document's own), kind, generated,
    start, end, hit, before, after; a document without matches has one row without kind."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    patterns = [(k, p, g) for g, source in ((False, BASE), (True, GENERATORS)) for k, p in source.items()]
    found = F.when(F.col("text").rlike(MAY_MATCH), F.flatten(F.array(*[_matches(*p) for p in patterns])))
    each = rows.select("doc_id", "row", F.explode_outer(found).alias("m")).select("doc_id", "row", "m.*")
    length = F.length("hit").cast("long")
    end = F.sum(F.col("gap") + length).over(Window.partitionBy("row", "generated", "kind").orderBy("i"))
    return each.withColumn("end", end).withColumn("start", F.col("end") - length).drop("gap", "i")


def _plain() -> Column:
    """The hit as a rule would have it: the loose ways of writing a kind are made one."""
    sub = lambda c, *pairs: reduce(lambda x, p: F.regexp_replace(x, *p), pairs, c)
    hit = F.col("hit")
    return (
        F.when(F.col("kind") == "email", sub(hit, (r"(?i)\s?(?:@|[(\[]at[)\]])\s?", "@"), (r"(?i)\s?(?:\.|[(\[]dot[)\]])\s?", ".")))
        .when(F.col("kind") == "ip", sub(hit, (r"\s?[.,]\s?", ".")))
        .when(F.col("kind") == "card", sub(hit, (r"[\x20./_-]+", " ")))
        .otherwise(sub(hit, (r"^00", ""), (r"[\x20()./-]+", " "), (r"^ | $", "")))
    )


def _features() -> dict[str, Column]:
    """Shape of the span, however loosely written, and of what stands around it."""
    digits, parts = _digits(F.col("hit")), F.split("hit", "[^A-Za-z0-9]+")
    return {
        "length": F.length("hit"),
        "digits": F.length(digits),
        "letters": F.length(F.regexp_replace("hit", "[^A-Za-z]", "")),
        "groups": F.size(parts),
        "longest_group": F.array_max(F.transform(parts, F.length)),
        "dots": F.length(F.regexp_replace("hit", "[^.]", "")),
        "spaces": F.length(F.regexp_replace("hit", r"[^\s]", "")),
        "luhn": F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False),
        "letter_before": F.col("before").rlike(r"\p{L}$"),
        "letter_after": F.col("after").rlike(r"^\p{L}"),
        "quoted": F.col("before").rlike("[\"'=]\\s?$"),
        "number_near": F.concat_ws(" ", "before", "after").rlike("[0-9]"),
        "word_near": F.col("before").rlike(r"(?i)\b(?:tel|phone|call|fax|mail|card|visa|konto|ip|host|addr)"),
        **{f"is_{k}": F.col("kind") == k for k in KINDS},
    }


def added_spans(matches: DataFrame, max_fit: int = MAX_FIT, precision: float = PRECISION) -> DataFrame:
    """The generated candidates that the trees select: doc_id, row, kind, start, end.

    The trees are fitted on at most ``max_fit`` candidates, the first of each kind and label
    by hash of document and offset.  A quarter of all candidates is held out of the fit; the
    threshold of a kind comes from the counts of all of these by score.  A candidate that no
    rule confirms is not an error, but unknown: of true candidates the rules confirm some
    share, which is taken from the best-scored half of the confirmed ones, and a threshold
    needs ``precision`` of that share.  Candidates crossing a base span of any kind add
    nothing and are left out.  Without candidates of both classes there is nothing to learn
    and nothing is added; a kind without a confirmed held-out candidate adds nothing.
    """
    features = _features()
    generated = F.col("generated")
    # The base spans of a kind are disjoint, so of those starting before a candidate's end
    # the last reaches farthest: a running maximum tells whether one crosses the candidate.
    points = matches.filter(generated | _valid(F.col("kind"), F.col("hit"))).withColumn("at", F.when(generated, F.col("end")).otherwise(F.col("start")))
    before = Window.partitionBy("row").orderBy("at", F.desc("generated")).rowsBetween(Window.unboundedPreceding, 0)
    reach = {k: F.max(F.when(~generated & (F.col("kind") == k), F.col("end"))).over(before).alias(f"reach_{k}") for k in KINDS}
    crossed = {k: F.coalesce(F.col(f"reach_{k}") > F.col("start"), F.lit(False)) for k in KINDS}
    own = F.coalesce(*[F.when(F.col("kind") == k, c) for k, c in crossed.items()])
    labelled = (
        points.select("*", *reach.values()).filter("generated")
        .withColumn("covered", reduce(Column.__or__, crossed.values()))
        .withColumn("label", own.cast("double"))
        .withColumn("order", F.xxhash64("doc_id", "row", "kind", "start"))
        .withColumn("hit", _plain()).withColumn("before", F.regexp_replace("before", r"\+$", ""))
        .select("doc_id", "row", "kind", "start", "end", "covered", "label", "order",
                *[c.cast("double").alias(f"f_{n}") for n, c in features.items()])
    )
    rows = VectorAssembler(inputCols=[f"f_{n}" for n in features], outputCol="features").transform(stage(labelled, "pii-candidates"))
    held_out = F.pmod("order", F.lit(4)) == 0
    first = Window.partitionBy("kind", "label").orderBy("order")
    fit = stage(
        rows.filter(~held_out).select("order", "kind", "label", "features").withColumn("number", F.row_number().over(first))
        .filter(F.col("number") <= max(1, max_fit // (2 * len(KINDS)))).select("label", "features"),
        "pii-sample",
    )
    none = rows.filter(F.lit(False)).select("doc_id", "row", "kind", "start", "end")
    if fit.select("label").distinct().count() < 2:
        return none
    fit = fit.cache()
    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=1, cacheNodeIds=False).fit(fit)
    fit.unpersist()
    score = lambda df: model.transform(df).withColumn("score", vector_to_array("probability")[1])
    counts = (
        score(rows.filter(held_out)).groupBy("kind", F.floor(F.col("score") * BINS).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("confirmed"), F.min("score").alias("least"))
    )
    best_first = Window.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("kind")
    share = F.col("up_to") / F.col("of")
    thresholds = (
        counts.withColumn("up_to", F.sum("confirmed").over(best_first)).withColumn("of", F.sum("n").over(best_first))
        .withColumn("all", F.sum("confirmed").over(whole)).filter(F.col("all") > 0)
        .withColumn("usual", F.max_by(share, F.when(F.col("up_to") * 2 >= F.col("all"), F.col("bin"))).over(whole))
        .filter(share >= F.lit(precision) * F.col("usual")).groupBy("kind").agg(F.min("least").alias("threshold"))
    )
    return (
        score(rows.filter(~F.col("covered"))).join(F.broadcast(thresholds), "kind")
        .filter(F.col("score") >= F.col("threshold")).select("doc_id", "row", "kind", "start", "end")
    )


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, order, end, kind)
    sorted by start and then by kind as in KINDS; ``spans`` holds the base ones and the ones
    the trees add.  Null texts are empty; ids may be null or repeated (each row is a
    document); other columns are ignored."""
    matches = stage(candidates(docs, id_col, text_col), "pii-matches")
    found = matches.select(
        "doc_id", "row", F.when(~F.col("generated") & _valid(F.col("kind"), F.col("hit")), F.col("kind")).alias("kind"),
        "start", "end", F.lit(True).alias("is_base"),
    ).unionByName(added_spans(matches, precision=precision).withColumn("is_base", F.lit(False)))
    order = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", order.alias("order"), "end", "kind"))
    return (
        found.groupBy("row")
        .agg(
            F.first("doc_id", ignorenulls=True).alias("doc_id"),
            F.sort_array(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
            F.sort_array(F.collect_set(span)).alias("spans"),
        )
        .drop("row")
    )


def redact(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (doc_id unique) with each span of its document replaced by ``[kind]``; of
    spans that cross each other the first is replaced and the rest go with it."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            s["end"].alias("at"),
        ),
    ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    joined = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id")).join(
        spans.select(F.col("doc_id").alias("id"), "spans"), "id", "left"
    )
    redacted = F.when(F.size("spans") > 0, done).otherwise(F.col("doc.text")).alias("text")
    return joined.select(*[redacted if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(Tables(spark, sf_dir)["documents"].select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(F.encode(_joined("base"), "UTF-8"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
    )
