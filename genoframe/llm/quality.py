"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics of the whole text, as column expressions.
2. A random forest of shallow trees is grown on a bounded sample of labelled
   rows; every path from a root to an inner or leaf node is one conjunctive
   rule (``symbol_ratio > 0.08 AND n_words <= 40``).
3. A lasso logistic regression over the rules keeps few of them.
4. The kept rules and weights are compiled into one Spark column expression, so
   scoring is a plain projection over the statistics.

Sample: labelled rows by a hash of their id, about ``sample_rows`` and never
more (default 20,000; about 20 numbers each).  The statistics of every
document are computed over its whole text.

Defined cases: null text is empty text; an empty text gets the score of its
all-zero statistics; rows without a quality label are not learned from, and
several labels of one id count as their largest; without labelled rows, or with
one class only, the score is that share of label 1 (0.5 without any); an empty
table gives an empty result; extra columns are kept, the added ones win over
equally named ones.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import fold, packed, text_of

Rule = tuple[tuple[str, str, float], ...]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of STATS instead of the text."""
    t, chars = F.col("_t"), F.greatest(F.col("_chars"), F.lit(1))
    words = F.greatest(F.size("_words"), F.lit(1))

    def left(pattern: str) -> Column:
        """Share of the characters left after removing ``pattern``."""
        return F.char_length(F.regexp_replace(t, pattern, "")) / chars

    def share(char: str) -> Column:
        return 1 - F.char_length(F.replace(t, F.lit(char), F.lit(""))) / chars

    parts = docs.withColumn("_t", text_of(text)).select(
        *[c for c in docs.columns if c != text],
        "_t",
        F.char_length("_t").alias("_chars"),
        F.split(F.trim("_t"), r"\s+").alias("_words"),
        F.split("_t", "\n").alias("_lines"),
    )
    return parts.select(
        *[c for c in docs.columns if c != text],
        F.log1p("_chars").alias("log_chars"),
        F.log1p(F.when(F.col("_chars") > 0, words).otherwise(0)).alias("log_words"),
        (F.col("_chars") / words).alias("chars_per_word"),
        (words / F.size("_lines")).alias("words_per_line"),
        (F.size(F.array_distinct("_words")) / words).alias("distinct_words"),
        (F.size(F.array_distinct("_lines")) / F.size("_lines")).alias("distinct_lines"),
        left(r"[^\p{Lu}]+").alias("upper"),
        left(r"[\p{L}\p{N}\s]+").alias("symbols"),
        left(r"[^0-9]+").alias("digits"),
        share(".").alias("periods"),
        share(",").alias("commas"),
        share("|").alias("bars"),
    )


STATS = (
    "log_chars", "log_words", "chars_per_word", "words_per_line", "distinct_words", "distinct_lines",
    "upper", "symbols", "digits", "periods", "commas", "bars",
)


def tree_rules(dump: str) -> list[Rule]:
    """The paths of all trees in a forest's ``toDebugString``: each condition
    met on the way down closes one rule."""
    rules: dict[Rule, None] = {}
    path: list[tuple[str, str, float]] = []
    for line in dump.splitlines():
        found = re.match(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if "Tree" in line:
            path, base = [], len(line) - len(line.lstrip()) + 2
        elif found:
            path = path[: len(found[1]) - base]  # one space more per level
            path.append((STATS[int(found[2])], found[3], float(found[4])))
            rules[_tight(path)] = None
    return list(rules)


def _tight(path: list[tuple[str, str, float]]) -> Rule:
    """The conjunction with one bound per statistic and direction."""
    bounds: dict[tuple[str, str], float] = {}
    for name, side, value in path:
        pick = min if side == "<=" else max
        bounds[name, side] = pick(bounds.get((name, side), value), value)
    return tuple(sorted((name, side, value) for (name, side), value in bounds.items()))


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, side, value in rule:
        out = out & (F.col(name) <= value if side == "<=" else F.col(name) > value)
    return out.cast("double")


def compiled(rules: list[tuple[Rule, float]], intercept: float) -> Column:
    """Probability of label 1 as one expression over the statistics."""
    logit = F.lit(float(intercept))
    for rule, weight in rules:
        logit = logit + holds(rule) * float(weight)
    return 1 / (1 + F.exp(-logit))


def fit(sample: DataFrame, trees: int = 20, depth: int = 3, lasso: float = 0.002) -> Column:
    """Grow, prune and compile, from (``STATS``, label) rows."""
    count, positive = sample.agg(F.count("*"), F.coalesce(F.avg("label"), F.lit(0.5))).first()
    if count == 0 or positive in (0.0, 1.0):
        return F.lit(float(positive))
    assembled = VectorAssembler(inputCols=list(STATS), outputCol="stats").transform(sample)
    forest = RandomForestClassifier(
        featuresCol="stats", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=11
    ).fit(assembled.select("stats", "label"))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return F.lit(float(positive))
    names = [f"r{i}" for i in range(len(rules))]
    marked = sample.select("label", *[holds(r).alias(n) for r, n in zip(rules, names)])
    marked = VectorAssembler(inputCols=names, outputCol="rules").transform(marked).select("rules", "label")
    model = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60
    ).fit(marked)
    weights = [(rule, w) for rule, w in zip(rules, model.coefficients.toArray().tolist()) if w != 0.0]
    return compiled(weights, model.intercept)


def learned(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int = 5,
    held: int = 0,
    sample_rows: int = 20_000,
    text: str = "text",
    doc: str = "doc_id",
    label: str = "quality",
) -> Column:
    """The compiled score, learned from labelled rows whose crc32(id as text)
    mod ``modulus`` is not ``held``.  Statistics are taken of sampled rows only;
    the sample is sorted in one partition, so that the forest does not depend on
    how the rows were laid out."""
    known = (
        labels.select(F.col(doc).alias("_id"), F.col(label).cast("double").alias("label"))
        .filter(F.col("_id").isNotNull() & F.col("label").isNotNull() & (fold("_id", modulus) != held))
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
    )
    known = stored(known, "quality-labels")
    share = 0.97 * sample_rows / max(1, known.count())  # leaves room for chance
    chosen = stored(known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < share * (1 << 20)).limit(sample_rows), "quality-chosen")
    rows = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    texts = rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_doc", "label", "_text")  # at most sample_rows ids
    sample = statistics(texts, "_text").withColumn("label", F.when(F.col("label") > 0, 1.0).otherwise(0.0))
    order = ["_doc", "label", *STATS]
    sample = stored(sample.limit(sample_rows).repartition(1).sortWithinPartitions(*order), "quality-sample")
    return fit(sample.select(*STATS, "label"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int = 5,
    held: int = 0,
    threshold: float = 0.3,
    sample_rows: int = 20_000,
    text: str = "text",
    doc: str = "doc_id",
    label: str = "quality",
) -> DataFrame:
    """(doc_id, _h, held_out, score, predicted) per row of ``docs``; ``_h`` is the
    hash of its text."""
    model = learned(docs, labels, modulus, held, sample_rows, text, doc, label)
    narrow = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(text_of(text)).alias("_h"), F.col(text).alias("_text"))
    return (
        statistics(narrow, "_text")
        .select("doc_id", "_h", (fold("doc_id", modulus) == held).alias("held_out"), model.alias("score"))
        .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", doc: str = "doc_id", **options
) -> DataFrame:
    """The rows of ``docs`` predicted 1, with the columns of ``docs``: a filter on
    the row itself, nothing is joined or shuffled.  The row number keeps the
    filter above the statistics, which would else be computed again per rule."""
    model = learned(docs, labels, text=text, doc=doc, **options)
    stats = statistics(packed(docs, _text=F.col(text)), "_text")
    scored = stats.select("row", model.alias("_score"), F.monotonically_increasing_id().alias("_at"))
    return scored.filter((F.col("_score") >= threshold) & (F.col("_at") >= 0)).select("row.*")
