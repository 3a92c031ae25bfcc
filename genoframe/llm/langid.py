"""Language identification: known words first, shorter and shorter n-grams else.

Training counts words per language and, from the distinct words, the character
n-grams of the word between boundary marks.  A known word adds its log
frequency in each language.  An unseen word adds the mean log frequency of its
known n-grams of the greatest length that has any, from four characters down to
one.  The language with the highest sum wins; the score is its posterior under
equal priors.

Every task receives at most ``max_words`` of the most frequent words and at most
``max_grams`` of the most frequent n-grams of each length: a size fixed by parameters, not by the
data.  That only saves time: a text's other words are joined by shuffle with
the full tables of words and n-grams, once per distinct word; what they come to
goes back to the texts by a 64-bit hash of the word.

Defined cases: null text, empty text and text without a letter give ``und`` and
score 0, and so does everything if nothing can be learned; a null id counts as
empty text for the fold; every row is predicted by itself, so repeated rows
agree; ties go to the language that sorts first; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import fold, frequent

ORDERS = (4, 3, 2, 1)
LETTERS = re.compile(r"[^\W\d_]+")  # also takes numerals that are not digits
MARK = "\u0002"


def words_of(text: str) -> list[str]:
    """Lower-case words; none if the text has no letter."""
    words = LETTERS.findall(text.lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of each task, added up until 200,000 pairs are held."""
    held: dict[str, Counter] = {}

    def take():
        rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
        held.clear()
        columns = zip(*rows) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["lang", "w", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(lang, Counter()).update(words_of(text.as_py()))
            if sum(map(len, held.values())) > 200_000:
                yield take()
    yield take()


class Model:
    """Log frequencies per language, one row per known word or gram, and the
    row numbers of the keys.  ``base`` holds the log frequency of a count of
    zero in each table, ``partial`` the orders whose n-grams are not all here,
    ``whole`` tells that nothing is missing."""

    def __init__(
        self, langs: list[str], words: dict[str, np.ndarray], grams: dict[int, dict[str, np.ndarray]],
        base: list[np.ndarray], partial: set[int], whole: bool,
    ):
        self.base, self.partial, self.whole = base, partial, whole
        tables = [words, *(grams[n] for n in ORDERS)]
        start = np.cumsum([0] + [len(t) for t in tables])
        self.langs = langs
        self.logs = np.array([row for t in tables for row in t.values()]).reshape(int(start[-1]), len(langs))
        self.words, *rest = ({k: int(s) + i for i, k in enumerate(t)} for t, s in zip(tables, start))
        self.grams = dict(zip(ORDERS, rest))

    def unseen(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of a word."""
        marked = f"{MARK}{word}{MARK}"
        for n in ORDERS:
            known = self.grams[n]
            rows = [known[g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in known]
            if rows:
                return rows
        return []

    def backoff(self, word: str) -> Iterator[tuple[int, str | None, int, np.ndarray]]:
        """(table, n-gram to look up or None, known n-grams, their summed log
        counts) of a word without a row, down to the first order that is known."""
        marked = f"{MARK}{word}{MARK}"
        for t, n in enumerate(ORDERS, 1):
            grams = [marked[i : i + n] for i in range(len(marked) - n + 1)]
            rows = [self.grams[n][g] for g in grams if g in self.grams[n]]
            if n in self.partial:
                for g in grams:
                    if g not in self.grams[n]:
                        yield t, g, 0, np.zeros(0)
            if rows:
                yield t, None, len(rows), (self.logs[rows] - self.base[t]).sum(0)
                return

    def known(self, text: str | None) -> tuple[bool, np.ndarray, Counter]:
        """Whether the text has words, the sum over those in the model, the others."""
        counts = Counter(words_of(text or ""))
        here = {w: n for w, n in counts.items() if w in self.words}
        total = np.array(list(here.values()), float) @ self.logs[[self.words[w] for w in here]] if here else np.zeros(len(self.langs))
        return bool(counts), total, Counter({w: n for w, n in counts.items() if w not in here})

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text or ""))
        if not counts or not self.langs:
            return "und", 0.0
        rows: list[int] = []
        weights: list[float] = []
        for word, n in counts.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                weights.append(n)
            elif grams := self.unseen(word):
                rows += grams
                weights += [n / len(grams)] * len(grams)
        total = np.array(weights) @ self.logs[rows] if rows else np.zeros(len(self.langs))
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def _logs(rows: pa.Table, langs: list[str], totals: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Add-one smoothed log frequency per language from (key, lang, n) rows."""
    at = {lang: i for i, lang in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    for key, lang, n in zip(*(rows.column(i).to_pylist() for i in range(3))):
        counts.setdefault(key, np.zeros(len(langs)))[at[lang]] = n
    return {k: np.log((v + 1) / (totals + size)) for k, v in counts.items()}


def train(labelled: DataFrame, max_words: int = 30_000, max_grams: int = 20_000) -> tuple[Model, list[DataFrame]]:
    """``labelled``: (lang, t) rows.  At most max_words + 4 x max_grams keys, each
    with a count per language, come to the driver.  Beside them the full stored
    tables (k, lang, n) of words and of n-grams in the order of ``ORDERS``."""
    words = stored(
        labelled.mapInArrow(_count, "lang string, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")), "lang-words", "zstd"
    )
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    marked = F.concat(F.lit(MARK), F.col("w"), F.lit(MARK))

    def kept(counts: DataFrame, limit: int) -> tuple[dict[str, np.ndarray], np.ndarray, bool]:
        per = dict(counts.groupBy("lang").agg(F.sum("n")).collect())
        totals = np.array([float(per.get(lang, 0)) for lang in langs])
        every = stored(counts.groupBy("k").agg(F.sum("n").alias("m")), "lang-totals", "zstd")  # read three times
        size = every.count()
        rows = counts.join(frequent(every, limit, "m").select("k"), "k").select("k", "lang", "n").toArrow()
        logs = _logs(rows, langs, totals, size)
        return logs, -np.log(np.maximum(totals + size, 1)), len(logs) < size

    tables = [words.select(F.col("w").alias("k"), "lang", "n")]
    for n in ORDERS:
        counts = (
            words.withColumn("_m", marked)
            .filter(F.length("_m") >= n)
            .select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("_m") - n + 1), _gram(n))).alias("k"))
            .groupBy("k", "lang")
            .agg(F.sum("n").alias("n"))
        )
        tables.append(stored(counts, "lang-counts", "zstd"))
    got = [kept(t, max_grams if i else max_words) for i, t in enumerate(tables)]
    partial = {n for n, g in zip(ORDERS, got[1:]) if g[2]}
    grams = {n: g[0] for n, g in zip(ORDERS, got[1:])}
    return Model(langs, got[0][0], grams, [g[1] for g in got], partial, not partial and not got[0][2]), tables


def _gram(n: int):
    return lambda i: F.col("_m").substr(i, F.lit(n))


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            got = [known.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


SUMS = "key long, doc_id long, held_out boolean, has boolean, total array<double>, rare array<string>, times array<int>"


def _sums(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                got = [model.value.known(t.as_py()) for t in part.column(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(3)),
                        pa.array([g[0] for g in got], pa.bool_()),
                        pa.array([g[1] for g in got], pa.list_(pa.float64())),
                        pa.array([list(g[2]) for g in got], pa.list_(pa.string())),
                        pa.array([list(g[2].values()) for g in got], pa.list_(pa.int32())),
                    ],
                    names=[f.split()[0] for f in SUMS.split(", ")],
                )

    return run


def _backoffs(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.float64()))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = [(w, *x) for w in batch.column(0).slice(at, 1000).to_pylist() for x in model.value.backoff(w)]
                columns = zip(*rows) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["w", "t", "k", "g", "sums"])

    return run


def _resolved(missing: DataFrame, tables: list[DataFrame], model: Model, shipped) -> DataFrame:
    """(w, vec): the log frequencies of words outside the model, from the full tables."""
    place = F.array_position(F.array(*[F.lit(x) for x in model.langs]), F.col("lang")).cast("int") - 1
    sparse = lambda df: df.select("k", place.alias("at"), F.log(F.col("n") + 1).alias("x"))

    def dense(df: DataFrame) -> DataFrame:  # from (w, t, g, xs): the sums per language, of g n-grams
        base = F.array(*[F.array(*[F.lit(float(x)) for x in b]) for b in model.base])
        vec = F.transform(
            F.sequence(F.lit(0), F.lit(len(model.langs) - 1)),
            lambda i: F.get(F.get(base, F.col("t")), i) + F.coalesce(F.try_element_at("xs", i), F.lit(0.0)) / F.col("g"),
        )
        return df.select("w", vec.alias("vec"))

    xs = F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("xs")
    words = missing.join(sparse(tables[0]).withColumnRenamed("k", "w"), "w").groupBy("w").agg(xs)
    words = dense(words.select("w", F.lit(0).alias("t"), F.lit(1).alias("g"), "xs"))
    unseen = missing.join(tables[0].select(F.col("k").alias("w")), "w", "left_anti")
    tried = stored(unseen.mapInArrow(_backoffs(shipped), "w string, t int, k string, g long, sums array<double>"), "lang-backoff", "zstd")
    here = tried.filter("k IS NULL")
    parts = here.select("w", "t", F.posexplode("sums").alias("at", "x")).unionByName(here.select("w", "t", F.lit(-1).alias("at"), F.col("g").cast("double").alias("x")))
    asked = tried.filter("k IS NOT NULL").select("w", "t", "k")
    for t, n in enumerate(ORDERS, 1):
        if n in model.partial:
            grams = sparse(tables[t]).groupBy("k").agg(F.collect_list(F.struct("at", "x")).alias("xs"))
            one = F.array(F.struct(F.lit(-1).alias("at"), F.lit(1.0).alias("x")))
            hits = asked.filter(F.col("t") == t).join(grams, "k").select("w", "t", F.explode(F.concat("xs", one)).alias("e"))
            parts = parts.unionByName(hits.select("w", "t", "e.at", "e.x"))
    best = (
        parts.groupBy("w", "t", "at").agg(F.sum("x").alias("x"))
        .groupBy("w", "t").agg(F.max(F.when(F.col("at") < 0, F.col("x"))).alias("g"), xs)
        .groupBy("w").agg(F.min_by(F.struct("t", "g", "xs"), "t").alias("b"))
    )
    return stored(words.unionByName(dense(best.select("w", "b.t", "b.g", "b.xs"))), "lang-rare", "zstd")


def identify(
    docs: DataFrame, modulus: int = 3, held: int = 1, text: str = "text", doc: str = "doc_id", lang: str = "lang", **sizes
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``; learns from rows
    with a language whose crc32(id as text) mod ``modulus`` is not ``held``."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), (fold(doc, modulus) == held).alias("held_out"), F.col(text).alias("t"), F.col(lang).alias("lang"))
    model, tables = train(rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("t").isNotNull()).select("lang", "t"), **sizes)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    if model.whole:
        return rows.select("doc_id", "held_out", "t").mapInArrow(_predict(shipped), PREDICTED)
    scored = stored(
        rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "held_out", "t").mapInArrow(_sums(shipped), SUMS), "lang-scored", "zstd"
    )
    missing = stored(scored.select(F.explode("rare").alias("w")).distinct(), "lang-missing", "zstd")
    vectors = _resolved(missing, tables, model, shipped)
    vectors = vectors.select(F.xxhash64("w").alias("h"), "vec")  # words move as hashes only
    each = range(len(model.langs))
    more = (
        scored.select("key", F.explode(F.arrays_zip("rare", "times")).alias("r"))
        .select(F.xxhash64("r.rare").alias("h"), "key", "r.times")
        .join(vectors.hint("merge"), "h")  # the size of the files does not tell that of lists
        .groupBy("key")
        .agg(F.array(*[F.sum(F.col("times") * F.get("vec", F.lit(i))) for i in each]).alias("more"))
    )
    total = F.when(F.col("more").isNull(), F.col("total")).otherwise(F.zip_with("total", "more", lambda a, b: a + b))
    best = F.array_max("sums")
    names = F.array(*[F.lit(x) for x in model.langs])
    return scored.join(more, "key", "left").withColumn("sums", total).select(
        "doc_id",
        "held_out",
        F.when(F.col("has"), F.get(names, F.array_position("sums", best).cast("int") - 1)).otherwise("und").alias("lang_pred"),
        F.when(F.col("has"), 1 / F.aggregate("sums", F.lit(0.0), lambda a, x: a + F.exp(x - best))).otherwise(0.0).alias("score"),
    )
