"""Nulls, empty and very long texts, repeated rows, ties, empty tables and
clashing column names, for every operator."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from genoframe.llm import ctw, decontaminate, langid, line_dedup, minhash, mixing, pii, quality, topk, warc

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, size long, row string, key string, "
    "h long, _h long, _doc long, n_lines long, hash long, word string, n long, id long"
)
PHRASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LONG = " ".join(f"w{i % 5000}x" for i in range(60_000)) + " " + PHRASE + " mail me a.b@c.example " + "9" * 30_000 + " " + "a" * 30_000


def _row(doc, text, lang="en", source="s1"):
    return (doc, text, lang, source, None if text is None else len(text), 0.5, 1, "r", "k", 1, 2, 3, 4, 5, "w", 6, 7)


ROWS = [
    _row(1, "one two three four five six seven\nsecond line of this very document here"),
    _row(1, "one two three four five six seven\nsecond line of this very document here"),  # repeated row
    _row(1, "the same id with another text altogether, that is all", source="s2"),
    _row(2, "ONE two three four five six seven\nsecond line of this very document here", source="s2"),
    _row(3, None),
    _row(4, ""),
    _row(5, "   \n\t\n "),
    _row(6, "word"),
    _row(7, LONG, source="s3"),
    _row(None, "no id but some words in a row to work on", source=None),
    _row(None, None, None, None),
    _row(9, f"before it {PHRASE.upper()} after it", None),
    _row(10, "12345 !!! 67890", "de", None),
    _row(11, "ein deutscher satz mit wörtern über straßen und häuser", "de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PHRASE), (1, PHRASE), (2, None), (None, PHRASE), (3, "word"), (4, "!!!"), (5, "deutscher satz")]
    return spark.createDataFrame(rows, "item_id long, text string")


def spark_rows(like, rows):
    return like.sparkSession.createDataFrame(rows, "doc_id long, text string")


def by_row(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (9, None), (None, 1), (11, 0)], "doc_id long, quality int")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep_good(docs, labels).columns == docs.columns
    only = labels.limit(0)
    assert {r.score for r in quality.score(docs, only).collect()} == {0.5}
    assert quality.keep_good(docs, only).count() == len(ROWS)
    assert quality.score(none, labels).count() == 0


def test_decontamination(docs, none, items):
    got = decontaminate.decontaminate(docs, items).select("_doc", "n_words", "n_hit", "found")
    want = brute.decontaminate([(r[0], r[1]) for r in ROWS], [(r.item_id, r.text) for r in items.collect()])
    assert by_row(got) == sorted(want, key=str)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(1 for w in want if not w[2])
    assert decontaminate.decontaminate(none, items).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}


def test_pii(docs, none):
    got = pii.find(docs).select("_doc", pii.joined("base").alias("s"))
    want = [(r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(r[1]))) for r in ROWS]
    assert by_row(got) == sorted(want, key=str)
    assert pii.find(none).count() == 0


def test_mixing(docs, none):
    out = mixing.mix(docs)
    assert out.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "taken"]
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert by_row(out.select("doc_id", "taken")) == by_row(mixing.mix(docs).select("doc_id", "taken"))
    assert mixing.mix(none).count() == 0
    blank = docs.filter("text = ''")
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0)]


def test_language(docs, none):
    rows = langid.identify(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 10)} == {"und"}
    assert langid.identify(none).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_near_duplicates(docs, none):
    rows = {r.id: r for r in minhash.near_duplicates(docs, width=4).collect() if r.id is not None}
    assert rows[2].component_id == 1 and not rows[2].kept  # differs by case only
    assert all(rows[i].n_shingles == 0 and rows[i].kept for i in (3, 4, 5))
    assert rows[6].n_shingles == 1
    kept = minhash.deduplicate(docs, width=4)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 1, 1, 3, 4, 5, 6, 7, 9, 10, 11]
    three = "one two three four five six seven eight nine ten"
    more = spark_rows(docs, [(1, three), (1, "another text with words that no other row has at all"), (2, three), (None, three),
                             (None, "only here twice and without an id " + three[::-1]), (None, "ONLY here twice and without an id " + three[::-1])])
    got = sorted((r.id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(more, width=4).collect())
    assert got == [(0, 0, False), (0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.near_duplicates(none).count() == 0 and minhash.deduplicate(none).count() == 0


def test_warc(spark):
    rows = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (2, "v", "<p>x</p>"), (3, "u\r\nX: y", None), (4, "ü", ""), (None, "w", "<p>x</p>"),
            (5, "z", "é" * 200_000), (6, "z", "\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload long")
    got = warc.round_trip(pages).drop("uri").collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id) == [
        (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "revisit", 3), (5, "response", None),
        (6, "response", None),
    ]
    assert [(r.record_type, r.refers_to) for r in got if r.page_id is None] == [("revisit", 1)]
    assert {r.payload_bytes for r in got if r.page_id == 5} == {400_000}
    assert {r.record_type for r in warc.round_trip(pages, min_bytes=1000).collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []),
            (8, [1.0]), (None, [1.0, 0.0]), (50, [-1.0, 0.5]), (50, [-1.0, 0.5]), (100, [2.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score long")
    got = [tuple(r) for r in topk.top_k(vectors, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536), (50, 1, 0, -65536), (50, 2, 1, -65536), (100, 1, 8, 131072)]
    assert topk.top_k(vectors.limit(0)).count() == 0


def test_line_dedup(docs, none):
    out = line_dedup.remove_boilerplate(docs)
    assert set(out.columns) == set(docs.columns) | {"n_removed"}
    texts = {(r.doc_id, r.source, r.n_removed): r.text for r in out.collect()}
    assert texts[2, "s2", 1] == "ONE two three four five six seven"
    assert texts[1, "s1", 0] == ROWS[0][1] and texts[3, "s1", 0] is None
    assert line_dedup.remove_boilerplate(none).count() == 0


def test_language_model(docs, none):
    rows = ctw.score(docs).collect()
    assert len(rows) == len(ROWS)
    assert {(r.n_tokens, r.score) for r in rows if r.doc_id in (3, 4)} == {(1, 0.0)}
    assert all(r.score < 0 for r in rows if r.n_bytes)
    assert ctw.score(none).count() == 0
