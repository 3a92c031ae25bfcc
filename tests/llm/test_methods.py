"""The methods themselves: skew, trees, graphs, archives, patterns."""

from __future__ import annotations

import io
import random
import re
import zlib

import numpy as np

from genoframe.llm import ctw, decontaminate, langid, line_dedup, minhash, pii, quality, topk, warc
from genoframe.llm.common import keyed
from genoframe.llm.components import components


def test_components_of_chain_star_and_ring(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 60)} | {i: 200 for i in range(200, 203)}


def test_near_copies_of_one_base_are_one_group(spark):
    """Copies of one text with edits of their own: most pairs of copies are not
    linked, but all are reachable through others."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 2, 4, 5])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    import brute

    want = brute.near_components(rows, 5)
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_estimate_is_corrected_for_chance():
    rng = np.random.RandomState(0)
    shared, a, b = (rng.randint(0, 2**62, n).astype(np.uint64) for n in (4000, 1000, 1000))
    one, two = (minhash.minima(np.unique(np.concatenate([shared, x]))) for x in (a, b))
    x = minhash.pack(one) ^ minhash.pack(two)
    differing = sum(bin((int(v) | int(v) >> 1) & 0x5555555555555555).count("1") for v in x.view(np.uint64))
    assert abs(((128 - differing) / 128 - 0.25) / 0.75 - 4000 / 6000) < 0.15


def test_ball_tree_search_is_exact():
    rng = np.random.RandomState(1)
    vectors = np.floor(rng.randn(1500, 16) * 40).astype(np.int64)
    vectors[100:160] = vectors[99]
    ids = rng.permutation(1500).astype(np.int64)
    chosen = np.flatnonzero(ids % 50 == 0)
    scores, found = topk.search(ids, vectors, ids[chosen], vectors[chosen], np.full(len(chosen), -np.inf), 5, False)
    for row, q in enumerate(chosen):
        best = sorted((-int(vectors[q] @ v), int(i)) for i, v in zip(ids, vectors) if i != ids[q])[:5]
        assert [(-s, i) for s, i in best] == list(zip(scores[row].tolist(), found[row].tolist()))


def test_normaliser_gives_one_member_per_record():
    body = [b"a" * 10, b"", bytes(range(256)) * 9000]
    raw = b"".join(warc.record(i, "http://x", p, "D", None) for i, p in enumerate(body))
    half = len(raw) // 2
    for source in (zlib.compress(raw, wbits=31), zlib.compress(raw[:half], wbits=31) + zlib.compress(raw[half:], wbits=31)):
        out = io.BytesIO()
        index = list(warc.normalise(io.BytesIO(source), out))
        assert [e["id"] for e in index] == [f"<{warc.URN}{i}>" for i in range(3)]
        for e, p in zip(index, body):
            member = zlib.decompress(out.getvalue()[e["offset"] : e["offset"] + e["length"]], 31)
            assert member.startswith(b"WARC/1.1") and p in member
        assert sum(e["length"] for e in index) == len(out.getvalue())


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"please call desk +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(100 + i, f"please write to user{i}@mail.example.com soon or later") for i in range(30)]
    rows += [(200, "please write to user99@mailhost soon"), (201, "he sold 99 boats and user7@x at sea")]
    got = {r._doc: [tuple(s)[1:] for s in r.spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(k, a, b) for a, b, k, own in got[100]] == [("email", 16, 38)]
    assert got[201] == []  # another context
    rows = [(i, f"contact card holder number {n} thanks") for i, n in enumerate(["4041894974608795", "4337166598464399", "4944339490429605", "4279055890764913"] * 2)]
    rows += [(50 + i, f"contact card holder number 404189497460879{i} thanks") for i in (1,)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), confidence=0.7).collect()
    new = [s for r in found if r._doc == 51 for s in r.spans]
    assert [(s.kind, s.own) for s in new] == [("card", False)]  # fails the check sum, found by its context


def _two_hops():
    rows = [(i, f"please write to user{i}@mail.example.com soon") for i in range(40)]
    hosts = [f"clerk{i}@intranet" for i in range(4)]  # no base form
    rows += [(100 + i, f"please write to {h} soon") for i, h in enumerate(hosts)]
    rows += [(200 + i, f"the desk of {hosts[i % 4]} is closed") for i in range(24)]  # a context no base entity stands in
    rows += [(300, "the desk of night@backup is open"), (301, "a price of 1234 or 99@x in words"), (302, None), (303, "")]
    return rows + [(400 + i, f"call +1 (555) 010-{1000 + i} or pay 12{i:03d}") for i in range(9)]


def test_discovered_values_lead_to_further_patterns(spark):
    docs = spark.createDataFrame(_two_hops(), "doc_id long, text string")
    found = lambda n: {r._doc: [s.kind for s in r.spans if not s.own] for r in pii.find(docs, rounds=n).collect()}
    one, more = found(1), found(4)
    assert one[100] == ["email"] and one[300] == []
    assert more[300] == ["email"] and more[200] == ["email"] and more[301] == []


def test_discovered_spans_equal_brute_force(spark):
    import brute

    rng = random.Random(11)
    rows = [(i, t or "") for i, t in _two_hops()]
    leads = ["mail me", "ring up", "host is", "order no", "see", ""]
    for i in range(500, 900):
        lead = rng.choice(leads)
        value = rng.choice(
            [f"a{rng.randrange(30)}@b.org", f"a{rng.randrange(9)}@b", f"+44 20 7946 0{rng.randrange(100, 130)}",
             f"0207-946-{rng.randrange(100, 120)}", f"10.0.0.{rng.randrange(300)}", f"({rng.randrange(1000, 1040)})", "12"]
        )
        if rng.random() < 0.7:
            value = {"mail me": f"a{rng.randrange(30)}@b.org", "ring up": f"+44 20 7946 0{rng.randrange(100, 130)}", "host is": f"10.0.0.{rng.randrange(260)}"}.get(lead, value)
        rows.append((i, f"so {lead} {value}, then {rng.choice(leads)} {rng.randrange(5000)}."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = lambda text: [tuple(s) for s in brute.base_spans(text)]
    got = {(r._doc, s.kind, s.start, s.end) for r in pii.find(docs, confidence=0.6).collect() for s in r.spans if not s.own}
    text = dict(rows)
    clash = lambda d, a, b: any(a < y and x < b for _, x, y in base(text[d]))
    want = {x for x in brute.discovered(rows, base, confidence=0.6) if not clash(x[0], x[2], x[3])}
    assert got == want and len(got) > 20


def test_frequent_fills_a_class_that_does_not_fit(spark):
    from genoframe.llm.common import frequent

    counts = spark.range(5000).selectExpr("id AS k", "7L AS n")
    assert 700 < frequent(counts, 1000).count() <= 1000
    assert frequent(counts, 5000).count() == 5000 and frequent(counts.limit(0), 10).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "x red green blue y"), (2, "red and then also green blue"), (3, "red green"), (4, "blue " + "z " * 30 + "red far " + "z " * 30 + "green")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    index = decontaminate.Index(keyed(docs), decontaminate.item_table(items), 10)
    exact = {r._doc for r in decontaminate.phrase_matches(index).collect() if r.found}
    near = {r._doc for r in decontaminate.proximity_matches(index, slop=4).collect()}
    assert exact == {1}
    assert near == {1, 2}, near  # 3 lacks a word, the words of 4 lie too far apart


def test_hot_line_counts_sites_exactly_near_the_threshold(spark):
    rows = [(i, "a line that is on many sites\nown line number %d of this document" % i, f"s{i}") for i in range(60)]
    rows += [(100, "on three sites and no more here", "a"), (101, "on three sites and no more here", "b"),
             (102, "on three sites and no more here", "c"), (103, "on three sites and no more here", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    removed = lambda n: {r.doc_id for r in line_dedup.remove_boilerplate(docs, min_sites=n).collect() if r.n_removed}
    assert removed(3) == set(range(1, 60)) | {101, 102, 103}
    assert removed(4) == set(range(1, 60))


def test_rules_read_from_trees():
    dump = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 6 <= 0.25)
     If (feature 4 <= 0.5)
      Predict: 0.0
     Else (feature 4 > 0.5)
      Predict: 1.0
    Else (feature 6 > 0.25)
     Predict: 0.0
"""
    upper, distinct = quality.STATS[6], quality.STATS[4]
    assert quality.tree_rules(dump) == [
        ((upper, "<=", 0.25),),
        ((distinct, "<=", 0.5), (upper, "<=", 0.25)),
        ((distinct, ">", 0.5), (upper, "<=", 0.25)),
        ((upper, ">", 0.25),),
    ]


def test_native_operators_run_no_python(spark, sf_dir):
    import genoframe.llm.queries as queries

    for name in ("op2_decontamination", "op3_pii", "op4_mixing", "op9_line_dedup"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def test_contexts_outside_the_broadcast_model_are_looked_up(spark):
    import brute

    rng = random.Random(5)
    letters, follows, rows = "abcdefgh", {}, []
    for i in range(40):  # three letters tell the next one
        text = "あ漢"
        while len(text) < 150:
            text += rng.choice(letters) if rng.random() < 0.1 else follows.setdefault(text[-3:], rng.choice(letters))
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = [t.encode() for i, t in rows if not brute.held(i, 7, 2)]
    whole = {r.doc_id: r.score for r in ctw.score(docs).collect()}
    for size in (64, 0):
        got = {r.doc_id: r.score for r in ctw.score(docs, contexts=size).collect()}
        assert all(abs(got[i] - whole[i]) < 1e-3 for i in whole)
        for i, t in [r for r in rows if brute.held(r[0], 7, 2)][:2] + rows[:2]:
            bits = brute.ctw_bits(training, t.encode(), ctw.DEPTH)
            assert abs(got[i] / (-bits * np.log10(2)) - 1) < 1e-4


def test_rare_words_move_as_hashes(spark):
    """Texts meet the words that the model lacks by a hash, not by the word."""
    rows = [(i, f"{w} {w}er {i}x{w}", lang) for i, (w, lang) in enumerate([("haus", "de"), ("house", "en"), ("maison", "fr")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, max_words=2, max_grams=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[h#\d+L\], \[h#\d+L\]", plan) and not re.search(r"Join \[w#", plan)
    assert all(r.lang_pred == lang for r, (_, _, lang) in zip(out.orderBy("doc_id").collect(), rows))


def test_words_outside_the_broadcast_model_are_looked_up(spark):
    rng = random.Random(7)
    letters = {"a": "abcdefghijk", "b": "fghijklmnop", "c": "aeioklmnstñ"}
    vocabulary = {lang: ["".join(rng.choice(x) for _ in range(rng.randrange(1, 7))) for _ in range(150)] for lang, x in letters.items()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) for _ in range(6)), lang) for i, lang in enumerate("abaaac" * 20)] + [(900, " 12 ", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r.doc_id: r for r in langid.identify(docs).collect()}
    for sizes in ({"max_words": 40, "max_grams": 20}, {"max_words": 0, "max_grams": 0}, {"max_words": 40}, {"max_grams": 20}):
        got = {r.doc_id: r for r in langid.identify(docs, **sizes).collect()}
        assert got.keys() == whole.keys()
        for i, r in whole.items():
            assert got[i].lang_pred == r.lang_pred and abs(got[i].score - r.score) < 1e-9
