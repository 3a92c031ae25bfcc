"""The registered queries on the small tables: SQL oracles and brute force."""

from __future__ import annotations

import hashlib
import math

import brute
import pytest
from helpers import duck_rows, rowset, spark_rows

import genoframe.llm.queries as queries
from genoframe.llm import ctw

SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def result(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    scols, srows = spark_rows(queries.QUERIES[name](spark, sf_dir))
    ocols, orows = duck_rows(duck, queries.ORACLES[name])
    assert sorted(scols) == sorted(ocols)
    assert rowset(scols, srows) == rowset(ocols, orows)


def test_quality_separates_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = result(spark, SF_MID, "op1_quality")
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == brute.held(r["doc_id"], 5, 0) and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in out) >= 0.95 * len(out)


def test_language_of_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in result(spark, SF_MID, "op5_langid") if r["held_out"]]
    assert all(brute.held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_pii_base_is_exact(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in result(spark, sf_dir, "op3_pii")}
    for doc, text, _ in docs:
        spans = brute.base_spans(text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[doc]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(got[doc]["spans"].split(","))


def test_near_duplicates_are_exact(spark, sf_dir, docs):
    want = brute.near_components([(i, t) for i, t, _ in docs], 4)
    for r in result(spark, sf_dir, "op6_minhash"):
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_warc_round_trip(spark, sf_dir, duck):
    import base64

    want = {}
    first = {}
    for page, html in duck.execute("SELECT page_id, html FROM pages ORDER BY page_id").fetchall():
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        refers = first.setdefault(digest, page)
        want[page] = (len(raw), digest, "response" if refers == page else "revisit", None if refers == page else refers)
    got = {r["page_id"]: tuple(r.values())[1:] for r in result(spark, sf_dir, "op7_warc")}
    assert got == want


def test_language_model(spark, sf_dir, docs):
    import collections

    counts, tokens = collections.Counter(), {}
    for doc, text, _ in docs:
        tokens[doc] = text.encode().lower().split() + [b"</s> "]
        if not brute.held(doc, 7, 2):
            counts.update(tokens[doc])
    total, size = sum(counts.values()), len(counts)
    training = [t.encode() for d, t, _ in docs if not brute.held(d, 7, 2)]
    rows = {r["doc_id"]: r for r in result(spark, sf_dir, "op10_ctw")}
    for doc, r in rows.items():
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in tokens[doc])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens[doc])
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens[doc]), total)
        assert r["held_out"] == brute.held(doc, 7, 2)
    short = sorted((d for d, t, _ in docs if len(t) < 600), key=lambda d: d)[:2]
    texts = {d: t for d, t, _ in docs}
    for doc in short:  # the tree of all training texts, by plain recursion
        bits = brute.ctw_bits(training, texts[doc].encode(), ctw.DEPTH)
        assert rows[doc]["score"] == pytest.approx(-bits * math.log10(2), rel=1e-4)


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    import corpus_pipeline

    from genoframe.llm import quality
    from genoframe.session import stored

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain = lambda df: {r.doc_id: r for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]

    good = stored(stages["quality"](spark, docs, sf_dir), "t")
    keep = {r.doc_id for r in quality.score(docs, labels).filter("predicted = 1").collect()}
    assert set(plain(good)) == keep

    lines = stored(stages["line_dedup"](spark, good, sf_dir), "t")
    want = brute.remove_lines([(r.doc_id, r.text, r.source) for r in plain(good).values()])
    texts = {i: t for i, t in want.items() if t.strip(" ") or t == plain(good)[i].text}
    assert {i: r.text for i, r in plain(lines).items()} == texts
    assert all(r.n_chars == len(r.text) for i, r in plain(lines).items())

    single = stored(stages["near_duplicates"](spark, lines, sf_dir), "t")
    groups = brute.near_components([(i, r.text) for i, r in plain(lines).items()], 5)
    assert set(plain(single)) == {i for i, (_, c) in groups.items() if i == c}

    clean = stored(stages["decontamination"](spark, single, sf_dir), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = brute.decontaminate([(i, r.text) for i, r in plain(single).items()], items)
    assert set(plain(clean)) == {i for i, _, hit, _ in hits if not hit}
    assert clean.columns == docs.columns

    _, taken = brute.mix([(i, r.text, r.source) for i, r in plain(clean).items()])
    mixed = {r.doc_id: r.taken for r in stages["mixing"](spark, clean, sf_dir).collect()}
    assert mixed == {i: n for i, n in taken.items() if n}
    assert {r.doc_id: r.taken for r in corpus_pipeline.run(spark, sf_dir).collect()} == mixed
