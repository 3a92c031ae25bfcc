"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation is repaired by the cheapest edits (keep, rerole, delete, insert)
after which its role initials read ``(s?(ua)+)?``.  The automaton has four
states: nothing yet, after ``s``, after ``u``, after ``a``.  The cost to the end
from each state is a vector of four numbers, computed from the last row
backwards.

1. Rows get their place: a range sort by (conversation, turn, role, text), whose
   last key tells repeated rows apart so that no group of them stays whole.
   Blocks of ``block`` consecutive places cut every conversation into chunks;
   a chunk keeps one character per row (initial and fault).
2. Every chunk starts from a speculative cost vector at once; only the last one
   of a conversation knows its true one.
3. Fix-up passes: a chunk whose follower's vector turned out different, by more
   than a constant, runs again from that one, until its own vectors differ from
   the former ones by a constant only; from there on the former run holds.
   Passes repeat until nothing changes.  Chunks that still change after
   ``passes`` passes (rows without a role of the automaton can keep two vectors
   apart for ever) get their whole cost matrix, and matrices are multiplied by
   doubling, so the number of passes stays bounded by a logarithm.
4. The states at the chunks' starts follow by doubling, too.  Then each chunk
   traces the least audit: at every row the first of D, I, K, R that stays
   optimal by the stitched backward costs.
5. The repaired text streams once, sorted within its conversation, through a
   hash; SHA-256 takes its input in order, so one conversation's digest is one
   task's work.  Its memory does not depend on the conversation.

Defined cases: null role or text is one space; null turns come first and count
for no gap; a null conversation is one conversation; rows of one turn are taken
by role, the first 256 characters and a hash of their text; an empty table gives an empty result; a conversation without
rows has zeros, an empty audit and the hash of the empty string.  Other columns
play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

#: Costs of the edits.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a.
EMPTY, S, U, A = range(4)
Vector = tuple[int, int, int, int]
#: A step is initial * 4 + fault, written as one character.
INITIALS = {"s": 0, "u": 1, "a": 2}
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
BASE = 48
NONE = 1 << 40  # no way
#: Where an initial leads from a state, if anywhere.
KEEP = {(EMPTY, 0): S, (EMPTY, 1): U, (S, 1): U, (A, 1): U, (U, 2): A}
#: The one role that may come next, as user or assistant.
NEXT = {EMPTY: U, S: U, U: A, A: U}
END: Vector = (0, INSERT * 2, INSERT, 0)
ROLE = {U: "user", A: "assistant"}
SPACE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------ automaton
def choices(step: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) for a row, insertions left out."""
    initial, fault = divmod(step, 4)
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = CUT if fault == TRUNCATED else 0
    if (state, initial) in KEEP:
        yield "K", extra, KEEP[state, initial]
    yield "R", REROLE + extra, NEXT[state]


@lru_cache(maxsize=1 << 16)
def back(step: int, after: Vector) -> tuple[Vector, int]:
    """The cost vector before a row from that after it, less its least entry,
    and that entry."""
    direct = [min(cost + after[to] for _, cost, to in choices(step, state)) for state in range(4)]
    u, a = min(direct[U], INSERT + direct[A]), min(direct[A], INSERT + direct[U])
    full = (min(direct[EMPTY], INSERT + u), min(direct[S], INSERT + u), u, a)
    low = min(full)
    return tuple(x - low for x in full), low


def run_back(steps: str, end: Vector) -> tuple[Vector, int]:
    vector, total = end, 0
    for c in reversed(steps):
        vector, low = back(ord(c) - BASE, vector)
        total += low
    return vector, total


def fix_up(steps: str, old_end: Vector, old_start: Vector, old_total: int, end: Vector) -> tuple[Vector, int, int]:
    """Run again from ``end`` until the vectors are parallel to those from
    ``old_end``: (start vector, constant, rows run again)."""
    old, new, behind, total = old_end, end, 0, 0
    for n, c in enumerate(reversed(steps)):
        if old == new:  # normalised, so equal means parallel
            return old_start, total + old_total - behind, n
        old, low = back(ord(c) - BASE, old)
        behind += low
        new, low = back(ord(c) - BASE, new)
        total += low
    return new, total, len(steps)


def trace(steps: str, end: Vector, state: int, last: bool) -> tuple[str, int, int]:
    """(audit, state after, cost) of the ASCII-least cheapest edits."""
    vectors, lows = [end], []
    for c in reversed(steps):
        vector, low = back(ord(c) - BASE, vectors[-1])
        vectors.append(vector)
        lows.append(low)
    vectors.reverse()
    lows.reverse()
    out, cost = [], 0
    for n, c in enumerate(steps):
        step = ord(c) - BASE
        here, after, low = vectors[n], vectors[n + 1], lows[n]
        while True:
            best = min(
                [(e, x, to) for e, x, to in choices(step, state) if x + after[to] == here[state] + low]
                + [("I", INSERT, NEXT[state])] * (INSERT + here[NEXT[state]] == here[state]),
            )
            out.append(best[0])
            cost += best[1]
            state = best[2]
            if best[0] != "I":
                break
    while last and state in (S, U):
        out.append("I")
        cost += INSERT
        state = NEXT[state]
    return "".join(out), state, cost


# ------------------------------------------------------------------ rows
def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the faults that crc32(conv:turn) % 20 deals."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col(conv).cast("string"), blank), F.coalesce(F.col(turn).cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role_, text_ = F.coalesce(F.col(role), blank), F.coalesce(F.col(text), blank)
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role_).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text_, "[.!?]", "")).otherwise(text_).alias("text"),
        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, pos): ``pos`` grows in the order of conversation,
    turn, role and text.  Equal rows are told apart by where they were read;
    which of them comes first makes no difference."""
    text = [F.substring("text", 1, 256), F.xxhash64("text")]  # the bounds of a range sort go through the driver
    keys = [F.col("conv"), F.col("turn"), F.col("role"), *text, F.monotonically_increasing_id()]
    keyed = rows.select("*", *[k.alias(f"_k{n}") for n, k in enumerate(keys)])
    order = [F.asc_nulls_first(f"_k{n}") for n in range(len(keys))]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "dialogue-rows")


def chunks(rows: DataFrame, block: int) -> DataFrame:
    """(conv, block, first, steps) of the placed rows."""
    hashes = [F.xxhash64("role", "text"), F.xxhash64(F.lit(7), "text", "role")]
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    plain = rows.select(
        "conv",
        "pos",
        F.substring("role", 1, 1).alias("initial"),
        F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED).alias("fault"),
        hashes[0].alias("_a"),
        hashes[1].alias("_b"),
    )
    plain = stored(plain, "dialogue-marks")
    first = plain.filter(F.col("fault") != BLANK).groupBy("conv", "_a", "_b").agg(F.min("pos").alias("_first")).select("_first")
    # joined on the place, of which each row has its own: a text on very many rows is no hot key
    marked = plain.drop("_a", "_b").join(first, F.col("pos") == F.col("_first"), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    step = F.char(F.lit(BASE) + initial * 4 + fault)
    steps = F.transform(F.array_sort(F.collect_list(F.struct("pos", step.alias("step")))), lambda x: x["step"])
    return (
        marked.groupBy("conv", F.floor(F.col("pos") / block).alias("block"))
        .agg(F.min("pos").alias("first"), F.array_join(steps, "").alias("steps"))
    )


# ------------------------------------------------------------------ chunks
VECTOR = "array<bigint>"


def _each(columns: str, function):
    """A mapInArrow function: ``function`` gives a tuple for the named fields of a row."""
    names = [c.strip().split()[0] for c in columns.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [function(r) for r in batch.to_pylist()]
            values = list(zip(*out)) if out else [[]] * len(names)
            kinds = [pa.list_(pa.int64()) if VECTOR in c else pa.string() if "string" in c else pa.int64() for c in columns.split(",")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    return run


def _linked(pieces: DataFrame) -> DataFrame:
    """Chunks of conversations of several, with number, and the next one's first
    place.  The window sees one narrow row for each block of rows."""
    order = W.partitionBy("conv").orderBy("block")
    narrow = pieces.select("conv", "block", "first")
    narrow = narrow.withColumn("next", F.lead("first").over(order)).withColumn("no", F.row_number().over(order).cast("long"))
    return narrow.filter(F.col("next").isNotNull() | (F.col("no") > 1)).select("first", "next", "no")


def settle(parts: DataFrame, passes: int) -> tuple[DataFrame, int, bool]:
    """(first, next, no, steps, after): the vector after each chunk, up to a
    constant; how many fix-up passes it took, and whether they sufficed."""
    guess = F.array(*[F.lit(x).cast("long") for x in END])
    state = "first bigint, after array<bigint>, start array<bigint>, total bigint"

    def speculate(r: dict) -> tuple:
        start, total = run_back(r["steps"], tuple(r["after"]))
        return r["first"], r["after"], list(start), total

    def again(r: dict) -> tuple:
        start, total, _ = fix_up(r["steps"], tuple(r["after"]), tuple(r["start"]), r["total"], tuple(r["wanted"]))
        return r["first"], r["wanted"], list(start), total

    begun = parts.select("first", "steps", guess.alias("after"))
    now = stored(begun.mapInArrow(_each(state, speculate), state), "dialogue-vectors")
    for turn in range(passes + 1):
        follow = parts.select("first", F.col("next").alias("_n")).join(
            now.select(F.col("first").alias("_f"), F.col("start").alias("wanted")), F.col("_n") == F.col("_f")
        )
        wrong = now.join(follow.select("first", "wanted"), "first").filter("after <> wanted")
        wrong = stored(wrong, "dialogue-wrong")
        if wrong.isEmpty():
            return parts.join(now.select("first", "after"), "first"), turn, True
        if turn == passes:
            break
        mended = wrong.join(parts.select("first", "steps"), "first").mapInArrow(_each(state, again), state)
        now = stored(now.join(wrong.select("first"), "first", "left_anti").unionByName(mended), "dialogue-vectors")
    return _by_matrices(parts), passes, False


def _by_matrices(parts: DataFrame) -> DataFrame:
    """The exact vectors from cost matrices multiplied by doubling."""

    def matrix(r: dict) -> tuple:
        # entry (i, j): from state i before the chunk to state j after it
        columns = []
        for j in range(4):
            vector, total = run_back(r["steps"], tuple(0 if k == j else NONE for k in range(4)))
            columns.append([v + total for v in vector])
        return r["first"], r["next"], [min(columns[j][i], NONE) for i in range(4) for j in range(4)]

    kind = "first bigint, next bigint, m array<bigint>"
    now = stored(parts.select("first", "next", "steps").mapInArrow(_each(kind, matrix), kind), "dialogue-matrices")
    product = F.expr(
        "transform(sequence(0, 15), x -> array_min(transform(sequence(0, 3), k -> "
        f"least(m[cast(floor(x / 4) as int) * 4 + k] + o[k * 4 + x % 4], {NONE}L))))"
    )
    while not now.filter("next IS NOT NULL").isEmpty():
        other = now.select(F.col("first").alias("_f"), F.col("m").alias("o"), F.col("next").alias("_n"))
        joined = now.join(other, F.col("next") == F.col("_f"), "left")
        now = stored(
            joined.select("first", F.col("_n").alias("next"), F.when(F.col("o").isNull(), F.col("m")).otherwise(product).alias("m")),
            "dialogue-matrices",
        )
    final = F.array(*[F.lit(x).cast("long") for x in END])
    vector = F.expr("transform(sequence(0, 3), i -> array_min(transform(sequence(0, 3), j -> m[i * 4 + j] + e[j])))")
    starts = now.withColumn("e", final).select(F.col("first").alias("_f"), vector.alias("v"))
    starts = starts.withColumn("v", F.expr("transform(v, x -> x - array_min(v))"))
    return parts.join(starts, F.col("next") == F.col("_f"), "left").select(
        "first", "next", "no", "steps", F.coalesce("v", final).alias("after")
    )


def _entered(parts: DataFrame) -> DataFrame:
    """(first, state): the state before each chunk, by composing the chunks' maps
    from state to state by doubling."""

    def moves(r: dict) -> tuple:
        return r["first"], r["next"], [trace(r["steps"], tuple(r["after"]), s, False)[1] for s in range(4)]

    kind = "first bigint, next bigint, m array<bigint>"
    own = stored(parts.select("first", "next", "steps", "after").mapInArrow(_each(kind, moves), kind), "dialogue-moves")
    # now: from the start of a chunk over 2^k chunks, to the start of ``next``; known: chunks whose state is known
    known = stored(parts.filter("no = 1").select("first", F.lit(EMPTY).cast("long").alias("state")), "dialogue-states")
    now = own
    while True:
        step = now.filter("next IS NOT NULL")
        if step.isEmpty():
            return known
        reached = step.join(known, "first").select(F.col("next").alias("first"), F.expr("m[cast(state as int)]").alias("state"))
        known = stored(known.unionByName(reached), "dialogue-states")
        other = now.select(F.col("first").alias("_f"), F.col("next").alias("_n"), F.col("m").alias("o"))
        now = stored(
            step.join(other, F.col("next") == F.col("_f")).select(
                "first", F.col("_n").alias("next"), F.expr("transform(m, x -> o[cast(x as int)])").alias("m")
            ),
            "dialogue-moves",
        )


TRACED = (
    "first bigint, audit string, enter bigint, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "left string, right string"
)
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _traced(r: dict) -> tuple:
    steps = r["steps"]
    audit, _, cost = trace(steps, tuple(r["after"]), r["state"], r["next"] is None)
    codes = [divmod(ord(c) - BASE, 4) for c in steps]
    faults = [f for _, f in codes]
    illegal = sum((x, y) not in LEGAL for (x, _), (y, _) in zip(codes, codes[1:]))
    return (
        r["first"], audit, r["state"], cost, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal,
        "suao"[codes[0][0]], "suao"[codes[-1][0]],
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows; batches are ordered by
    (conv, pos, audit first), a conversation may go over many of them."""
    conv, hasher, audit, state, started = None, None, iter(""), EMPTY, False
    done: list[tuple] = []

    def add(role: str, text: str) -> None:
        nonlocal started
        hasher.update((("\n" if started else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        started = True

    def inserted() -> str | None:
        """The next edit, insertions done."""
        nonlocal state
        for edit in audit:
            if edit != "I":
                return edit
            state = NEXT[state]
            add(ROLE[state], "")
        return None

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], kind), pa.array([d for _, d in done], pa.string())], names=["conv", "digest"]
        )
        done.clear()
        return out

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for key, _, segment, enter, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if hasher is None or key != conv:
                if hasher is not None:
                    inserted()
                    done.append((conv, hasher.hexdigest()))
                conv, hasher, audit, started = key, hashlib.sha256(), iter(""), False
            if segment is not None:
                inserted()  # the end of the last chunk
                audit, state = iter(segment), enter
                continue
            edit = inserted()
            if edit == "K":
                state = KEEP[state, INITIALS[role[:1]]]
                add(role, text)
            elif edit == "R":
                state = NEXT[state]
                add(ROLE[state], text)
        if len(done) >= 4096:
            yield flush()
    if hasher is not None:
        inserted()
        done.append((conv, hasher.hexdigest()))
    if done:
        yield flush()


def repair(rows: DataFrame, block: int = 4096, passes: int = 4) -> DataFrame:
    """From (conv, turn, role, text): (conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, digest), one row per conversation that has rows."""
    rows = placed(rows)
    pieces = stored(chunks(rows, block), "dialogue-chunks")
    links = stored(_linked(pieces), "dialogue-links")
    final = F.array(*[F.lit(x).cast("long") for x in END])
    parts = stored(pieces.select("first", "steps").join(links, "first"), "dialogue-parts")
    settled, _, _ = settle(parts, passes)
    settled = stored(settled.select("first", "next", "steps", "after", "no"), "dialogue-settled")
    entered = _entered(settled).select(F.col("first").alias("_f"), "state")
    many = settled.join(entered, F.col("first") == F.col("_f")).select("first", "next", "steps", "after", "state")
    alone = pieces.join(links.select("first"), "first", "left_anti").select(
        "first", F.lit(None).cast("bigint").alias("next"), "steps", final.alias("after"), F.lit(EMPTY).cast("bigint").alias("state")
    )
    traced = many.unionByName(alone).mapInArrow(_each(TRACED, _traced), TRACED)
    traced = stored(pieces.select("conv", "first").join(traced, "first"), "dialogue-traced")

    # pairs across the ends of chunks
    ends = traced.select("first", "conv", "right").join(links.filter("next IS NOT NULL").select("first", "next"), "first")
    ends = ends.join(traced.select(F.col("first").alias("_f"), "left"), F.col("next") == F.col("_f"))
    across = ends.filter(~F.concat("right", "left").isin("su", "ua", "au")).groupBy("conv").agg(F.count("*").alias("across"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda x: x["audit"]), "")
    sums = traced.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], audit.alias("audit")
    )
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))

    void = lambda kind: F.lit(None).cast(kind)
    segments = traced.select("conv", F.col("first").alias("pos"), F.col("audit").alias("segment"), "enter", void("string").alias("role"), void("string").alias("text"))
    texts = rows.select("conv", "pos", void("string").alias("segment"), void("bigint").alias("enter"), "role", "text")
    stream = segments.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "pos", F.col("segment").isNull())
    kind = rows.schema["conv"].dataType.simpleString()
    digests = stream.mapInArrow(_digests, f"conv {kind}, digest string")

    def same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.withColumnRenamed("conv", "_c")
        return left.join(other, F.col("conv").eqNullSafe(F.col("_c")), how).drop("_c")

    out = same(same(same(sums, gaps, "left"), across, "left"), digests, "left")
    return out.select(
        "conv",
        F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + F.coalesce("across", F.lit(0))).alias("illegal"),
        "cost",
        "audit",
        "digest",
    )


def damaged_and_repaired(rows: DataFrame, block: int = 4096, passes: int = 4, **columns) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) for every conversation of ``rows``."""
    out = repair(damage(rows, **columns), block, passes)
    every = rows.select(F.col(columns.get("conv", "conv_id")).alias("conv_id")).distinct()
    joined = every.join(out, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(empty)).alias("repaired_sha256")
    )
