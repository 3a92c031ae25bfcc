"""Secret scans, conversation repair and phrase mining against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import genoframe.llm.queries as queries
from genoframe.llm import bits, dialogue, phrases, secret_scan

SF_MID = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ secrets
def plain_base(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_secret_base_spans_are_exact(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op11_secrets(spark, SF_MID).collect()
    assert len(rows) == len(texts) and any(r.n_assign for r in rows)
    for r in rows:
        want = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(line(want).encode()).hexdigest()
        assert collections.Counter(k for k, _, _ in want) == +collections.Counter(assign=r.n_assign, access=r.n_access, hex=r.n_hex)
        assert set(line(want).split(",")) - {""} <= set(r.spans.split(","))


def test_entropy_of_every_window():
    rng = random.Random(2)
    for chars, width, least in (("0123456789abcdef", 24, 3.1), ("ab", 6, 0.9), ("abcdefghijklm", 10, 2.5)):
        run = "".join(rng.choice(chars) if rng.random() < 0.7 else chars[0] for _ in range(400))
        over = set()
        for at in range(len(run) - width + 1):
            counts = collections.Counter(run[at : at + width]).values()
            if math.log2(width) - sum(c * math.log2(c) for c in counts) / width >= least - 1e-9:
                over |= set(range(at, at + width))
        got = {x for a, b in secret_scan.windows_over(run, width, least, secret_scan.entropy_table(width)) for x in range(a, b)}
        assert got == over


def test_entropy_spans_and_allow_list(spark):
    key, blob = "zQ9xK2mP7vR4tL8wN3bH6jF1", "q8Zr+T0vYb/7LkXw2MnE5sHd9JcGfU4aPiO1" * 2
    rows = [
        (1, f"naïve key {key} end"),
        (2, f"data:image/png;base64,{blob}"),
        (3, "id 550e8400-e29b-41d4-a716-446655440000 and /usr/local/lib/python/site_packages/module_name"),
        (4, "abcdefghijklmnopqrstuvwxyz0123456789 InternationalizationOfEverything"),
        (5, "commit 3f786850e387550fdab836ed7e6dc881de23001b"),
        (6, f"token: {key}"),
        (7, "a" * 300_000 + " " + "7" * 300_000),
        (8, None),
        (8, ""),
        (9, f"{key} and {key[::-1]}"),
    ]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, spans int, base string")
    got = sorted((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in secret_scan.find(docs).collect())
    hexes = [("hex", 7, 47)]
    assert got == [
        (1, [("entropy", 10, 34)]), (2, []), (3, []), (4, []), (5, hexes), (6, [("assign", 0, 31)]),
        (7, [("hex", 0, 300_000), ("hex", 300_001, 600_001)]), (8, []), (8, []), (9, [("entropy", 0, 24), ("entropy", 29, 53)]),
    ]
    listed = secret_scan.Rules(values=frozenset([key]))
    assert [r.spans for r in secret_scan.find(docs.filter("doc_id = 1"), listed).collect()] == [[]]
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs.filter("doc_id IN (1, 6)")).collect()}
    assert clean == {1: "naïve key [secret] end", 6: "[secret]"}
    assert secret_scan.find(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ conversations
def plain_damage(rows):
    """rows: (conv, turn, role, text) -> {conv: ordered [(turn, role, text)]}."""
    out = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out[conv] += [(turn, role, text)] * (2 if code == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def plain_repair(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    turn = {"": "u", "s": "u", "a": "u", "u": "a"}
    names = {"u": "user", "a": "assistant"}

    best = [{} for _ in range(len(rows) + 1)]  # state -> (cost, audit, rows), by rows from the end
    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
            if i < len(rows):
                _, role, text = rows[i]
                cost, audit, kept = best[i + 1][state]
                ways.append((4 + cost, "D" + audit, kept))
                if faults[i] not in ("b", "d"):
                    extra = 3 * (faults[i] == "t")
                    if (state, role[:1]) in step:
                        cost, audit, kept = best[i + 1][step[state, role[:1]]]
                        ways.append((extra + cost, "K" + audit, ((role, text), kept)))
                    cost, audit, kept = best[i + 1][turn[state]]
                    ways.append((3 + extra + cost, "R" + audit, ((names[turn[state]], text), kept)))
            best[i][state] = min(ways, key=lambda w: w[:2]) if ways else (10**9, "", ())
        for _ in range(3):  # insertions until nothing gets better
            for state in ("", "s", "u", "a"):
                cost, audit, kept = best[i][turn[state]]
                best[i][state] = min(best[i][state], (3 + cost, "I" + audit, ((names[turn[state]], ""), kept)), key=lambda w: w[:2])
    cost, audit, kept = best[0][""]
    out = []
    while kept:
        out.append(":".join(kept[0]))
        kept = kept[1]
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == x for f in faults) for x in "bdt"],
        sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def check_dialogue(df, rows, **options):
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.damaged_and_repaired(df, **options).collect()}
    want = {c: plain_repair(v) for c, v in plain_damage(rows).items()}
    assert got == want


def test_conversations_of_the_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_dialogue(spark, sf_dir).collect()}
    assert got == {c: plain_repair(v) for c, v in plain_damage(rows).items()}


def test_dialogue_edges(spark):
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (1, None, None, None), (1, None, "system", "x."), (1, 5, "user", " \t\n"),
            (1, 9, "user", "what?"), (1, 9, "user", "what?"), (1, 10, "", "no role."), (1, 11, "tool", "z."), (1, 12, "assistant", "the end"),
            (2, None, "user", "Only."), (3, -4, "assistant", "A."), (3, 4, "assistant", "B!"), (3, 4, "user", "C?"), (4, 7, "system", "s."),
            (5, 0, "user", "ü" * 100_000 + ".")]
    rows += [(6, t, "user", "same.") for t in range(12)] + [(10 + i, 0, "user", "Hm.") for i in range(60)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, pos int")
    check_dialogue(df, rows)
    empty = hashlib.sha256(b"").hexdigest()
    gone = [c for c, v in plain_damage(rows).items() if not v]
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.damaged_and_repaired(df).collect()}
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", empty) for c in gone)
    assert dialogue.damaged_and_repaired(df.limit(0)).count() == 0


@pytest.mark.parametrize("passes", [0, 3])
def test_long_conversations_in_chunks(spark, passes):
    """One conversation holds most rows, another only roles that keep the cost
    vectors apart, so that speculation never converges there."""
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice([f"text {t}.", "again!", "cut off", " "])) for t in range(120)]
    rows += [(2, t, "tool", f"call {t}.") for t in range(60)] + [(3, t, "user" if t % 2 == 0 else "assistant", f"line {t}.") for t in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check_dialogue(df, rows, block=8, passes=passes)


def test_fix_up_stops_where_vectors_are_parallel():
    steps = "".join(chr(dialogue.BASE + 4 * i) for i in (1, 2) * 500)
    start, total = dialogue.run_back(steps, dialogue.END)
    other = (3, 6, 0, 3)
    again, shift, rows = dialogue.fix_up(steps, dialogue.END, start, total, other)
    assert (again, shift) == dialogue.run_back(steps, other) and rows < 10


# ------------------------------------------------------------------ phrases
def plain_phrases(docs, support, longest, top):
    """docs: (text, lang) -> rows of the contract."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: c for p, c in f.items() if len(p) > 1 and c >= support}
        inside = {p[i : i + k] for p, c in frequent.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if c >= f[p[i : i + k]]}
        rows = []
        for p, a in frequent.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(6)
    stock = ["the cat sat on the mat", "in spite of the rain", "ÜBER den wolken ist die freiheit", "a a a a a a a"]
    rows = []
    for i in range(160):
        words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(40)]
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(stock) + rng.choice(["", ",", " .", "\n", "\t"]))
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" .,;\n", "xx"), ("long " * 9000 + "end of the line", "en"), ("one two", "rare")] + rows[:3]


@pytest.mark.parametrize("support, longest, piece_words, shards", [(12, 5, 300, 16), (12, 5, 10**6, 3), (5, 3, 50, 5), (9, 2, 200, 1)])
def test_phrases_in_shards(spark, phrase_rows, support, longest, piece_words, shards):
    df = spark.createDataFrame([(*r, 1, "w") for r in phrase_rows], "text string, lang string, n int, word string").repartition(5)
    got = phrases.collocations(df, support=support, longest=longest, top=30, piece_words=piece_words, shards=shards).collect()
    assert sorted(map(tuple, got)) == plain_phrases(phrase_rows, support, longest, 30)


def test_phrases_are_spelled_at_one_spot(spark, monkeypatch):
    """The step that spells the found phrases makes a row a phrase, however many pieces hold it."""
    made, show = spark.sparkContext.accumulator(0), phrases._show

    def counted(*args):
        run = show(*args)

        def step(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return step

    monkeypatch.setattr(phrases, "_show", counted)
    rows = [("one two three four five six seven. " * 3, "en")] * 200 + [("two three, five six", "de")] * 40
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    found, _ = phrases.frequent_phrases(df, 20, 5, 4, 100, "text", "lang")
    assert found.count() == 6 + 5 + 4 + 3 + 2
    assert 20 <= made.value <= 25  # before: one in each piece that holds it


def test_phrase_counts_travel_in_blocks(spark, phrase_rows, monkeypatch):
    """What a piece counts takes a row a range of hashes, not a row a phrase;
    phrases that share a cut hash are told apart."""
    made, texts = spark.sparkContext.accumulator(0), phrase_rows * 3

    def counted(step):
        def outer(*args):
            run = step(*args)

            def rows(batches):
                for batch in run(batches):
                    made.add(batch.num_rows)
                    yield batch

            return rows

        return outer

    for name in ("_mine", "_count"):
        monkeypatch.setattr(phrases, name, counted(getattr(phrases, name)))
    monkeypatch.setattr(phrases, "CUT_BITS", 18)
    monkeypatch.setattr(phrases, "SUM_BITS", 2)
    df = spark.createDataFrame(texts, "text string, lang string").repartition(4)
    got = phrases.collocations(df, support=20, top=30).collect()
    assert sorted(map(tuple, got)) == plain_phrases(texts, 20, 5, 30)
    partitions, langs, ranges, steps = 4, 5, 4, 4
    assert made.value <= partitions * langs * ranges * steps  # before: a row a phrase


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).count() == 0


def test_bitmap_misses_nothing(spark):
    keys = spark.range(0, 5000).selectExpr("xxhash64(id) AS key")
    filled = bits.bitmap(keys, "key", 12)
    rows = spark.range(0, 20000).selectExpr("id", "xxhash64(id) AS h")
    got = {r.id for r in bits.marked(rows, F.col("h"), filled, "hit", 12).filter("hit").collect()}
    assert set(range(5000)) <= got and filled.count() <= 64
    words = bits.as_array(filled, 12)
    h = rows.toPandas()["h"].to_numpy().view("uint64")
    assert set(bits.test(words, h).nonzero()[0].tolist()) == got
    assert not bits.test(bits.as_array(bits.bitmap(keys.limit(0), "key", 12), 12), h).any()
