"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions, from the high bit down.  A decision in
the context of the last d bytes (d = 0 .. 3) has a node with its counts of
zeros and ones and a Krichevsky-Trofimov (KT) estimate.  With Pe the KT block
probability of a node's counts, the weighted probability of a node is

    Pw = Pe at depth 3,   Pw = 1/2 Pe + 1/2 product of Pw(children) above,

so a node's own estimate has the weight (1/2 Pe) / Pw and its deeper context
the rest; the predictions of all depths are mixed with these weights.

Spark counts (three-byte context, next byte) over the training texts, each task
adding up its own before the shuffle, and rolls the tree up one byte of context
at a time by grouped sums.  The model sent to the scorers keeps the
``contexts`` most frequent deepest contexts and all shallower ones that have
any (at most 65,793): a fixed bound, kept in whole classes of about equal
counts.  That only saves time: a document's bytes in all other contexts are
joined by shuffle with the estimates of those contexts, so every score is that
of the whole tree.  Below a context that does not occur in training, the
parent's own estimate stands.

Word unigrams give the base score, add-one smoothed.  At most ``most`` of the
most frequent words go to the tasks; all other words of a document are joined with
the full table of counts by shuffle, so every count is exact.

Defined cases: null text is empty text (its one token is the end), a null id is
scored like any other, rows are scored one by one so repeated ids and rows stay
apart, an empty training set gives uniform bytes and V = 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import fold, frequent

DEPTH = 3
END = b"\n"  # no word holds white space, so this is free for the end token


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _codes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Three-byte contexts (last byte lowest; zeros before the text) and bytes."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    c = np.zeros(len(b), np.uint32)
    for d in range(1, DEPTH + 1):
        c[d:] |= b[:-d] << np.uint32(8 * (d - 1))
    return c, b


# ------------------------------------------------------------------ training


class _Counts:
    """Counts of (context, byte) in dense rows for the contexts met so far."""

    def __init__(self, contexts: int = 1 << 15):
        self.limit, self.row = contexts, np.full(1 << 24, -1, np.int32)
        self.start()

    def start(self) -> None:
        self.seen, self.used, self.n = [], 0, np.zeros((1024, 256), np.int64)

    def add(self, c: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
        """Add up; text with too many new contexts for dense rows comes back
        as counts of its own."""
        new = np.unique(c[self.row[c] < 0])
        if self.used + len(new) > 2 * self.limit:
            cell, times = np.unique(c.astype(np.int64) * 256 + b, return_counts=True)
            return self.batch(cell // 256, cell % 256, times)
        self.row[new] = self.used + np.arange(len(new))
        self.seen.append(new)
        self.used += len(new)
        if self.used > len(self.n):
            more = np.zeros((max(2 * len(self.n), self.used), 256), np.int64)
            more[: len(self.n)] = self.n
            self.n = more
        times = np.bincount(self.row[c].astype(np.int64) * 256 + b)
        self.n.reshape(-1)[: len(times)] += times
        return None

    def full(self) -> bool:
        return self.used >= self.limit

    def take(self) -> pa.RecordBatch:
        contexts = np.concatenate(self.seen).astype(np.int64) if self.seen else np.zeros(0, np.int64)
        row, byte = np.nonzero(self.n)
        out = self.batch(contexts[row], byte, self.n[row, byte])
        self.row[contexts] = -1
        self.start()
        return out

    @staticmethod
    def batch(c: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (c, b, n)], names=["c", "b", "n"])


def count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, waiting, size = _Counts(), [], 0
    for batch in batches:
        for text in batch.column(0):
            raw = text.as_py()
            for at in range(0, len(raw), 1 << 20):  # a very long text in pieces, each with its context
                c, b = _codes(raw[max(0, at - DEPTH) : at + (1 << 20)])
                skip = min(at, DEPTH)
                waiting.append((c[skip:], b[skip:]))
                size += len(b) - skip
                if size > 1 << 21:
                    yield from _added(counts, waiting)
                    waiting, size = [], 0
    yield from _added(counts, waiting)
    yield counts.take()


def _added(counts: _Counts, waiting: list) -> Iterator[pa.RecordBatch]:
    if waiting:
        apart = counts.add(*(np.concatenate(x) for x in zip(*waiting)))
        if apart is not None:
            yield apart
        if counts.full():
            yield counts.take()


def _log_gamma(x: Column) -> Column:
    """Stirling's series after eight steps of the recurrence."""
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    return (
        (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3)))
    ) - F.log(product)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """log of the KT block probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def _log_mix(a: Column, b: Column) -> Column:
    """log(exp(a)/2 + exp(b)/2)."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) - math.log(2)


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Node tables for depth 2, 1, 0: (c, node, zeros, ones, own): ``own`` is
    the weight of the node's own estimate."""
    bits = F.array(
        *[
            F.struct(
                (F.shiftright("b", 8 - i) + (1 << i)).cast("int").alias("node"),
                (F.shiftright("b", 7 - i) % 2).alias("bit"),
            )
            for i in range(8)
        ]
    )
    level = (
        leaves.select("c", "n", F.explode(bits).alias("x"))
        .groupBy("c", F.col("x.node").alias("node"))
        .agg(F.sum(F.col("n") * (1 - F.col("x.bit"))).alias("zeros"), F.sum(F.col("n") * F.col("x.bit")).alias("ones"))
        .withColumn("pw", _log_kt(F.col("zeros"), F.col("ones")))
    )
    out = []
    for depth in (2, 1, 0):
        up = (
            level.groupBy((F.col("c") % (1 << (8 * depth))).alias("c"), "node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("pw").alias("below"))
            .withColumn("pe", _log_kt(F.col("zeros"), F.col("ones")))
            .withColumn("own", 1 / (1 + F.exp(F.col("below") - F.col("pe"))))
            .withColumn("pw", _log_mix(F.col("pe"), F.col("below")))
        )
        level = stored(up, f"ctw-{depth}")
        out.append(level.select("c", "node", "zeros", "ones", "own"))
    return out


class Model:
    """log2 P(byte | context) as one row of 256 per known context."""

    def __init__(self, kept: np.ndarray, levels: list[np.ndarray], leaves: np.ndarray):
        """``levels[d]``: node rows (c, node, zeros, ones, own) of depth d;
        ``leaves``: (row of ``kept``, byte, n)."""
        ids: list[np.ndarray] = []
        estimates: list[np.ndarray] = []
        owns: list[np.ndarray] = []
        for rows in levels:
            c, p, own = self._nodes(rows)
            ids.append(c)
            estimates.append(p)
            owns.append(own)
        self.kept = kept
        self.ids = ids
        self.top = (ids[:2], estimates[:2], owns[:2])
        self.partial = False  # whether training has deepest contexts besides ``kept``
        # the estimate of the deepest known context, mixed with those above it
        self.rows = [self._logs(self._mixed(ids[d], estimates[d], d - 1, ids, estimates, owns)) for d in range(3)]
        leaves = leaves[np.argsort(leaves[:, 0], kind="stable")] if len(leaves) else leaves
        deepest = [np.zeros((0, 256), np.float32)]
        for at in range(0, len(kept), 2048):  # contexts in blocks: 512 tree nodes each
            a, b = np.searchsorted(leaves[:, 0], (at, at + 2048))
            p = self._leaves(min(2048, len(kept) - at), leaves[a:b, 0] - at, leaves[a:b, 1], leaves[a:b, 2])
            deepest.append(self._logs(self._mixed(kept[at : at + 2048], p, 2, ids, estimates, owns)))
        self.rows.append(np.concatenate(deepest))

    @staticmethod
    def _nodes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The contexts of node rows, and per context and node the estimate of
        a one and the weight of that estimate."""
        c = np.unique(rows[:, 0].astype(np.int64)) if len(rows) else np.zeros(1, np.int64)
        p, own = np.full((len(c), 256), 0.5), np.ones((len(c), 256))
        if len(rows):
            at, node = np.searchsorted(c, rows[:, 0].astype(np.int64)), rows[:, 1].astype(np.int64)
            p[at, node] = (rows[:, 3] + 0.5) / (rows[:, 2] + rows[:, 3] + 1)
            own[at, node] = rows[:, 4]
        return c, p, own

    @staticmethod
    def _leaves(size: int, row: np.ndarray, byte: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Estimates of the nodes of ``size`` deepest contexts from byte counts."""
        n = np.zeros((size, 512))
        n[row, 256 + byte] = times
        for node in range(255, 0, -1):
            n[:, node] = n[:, 2 * node] + n[:, 2 * node + 1]
        return (n[:, 1::2] + 0.5) / (n[:, 0::2] + n[:, 1::2] + 1)  # column k: ones of node k, its child 2k + 1

    @staticmethod
    def _mixed(c, p, depth, ids, estimates, owns):
        for d in range(depth, -1, -1):
            key = c % (1 << (8 * d))
            at = np.minimum(np.searchsorted(ids[d], key), len(ids[d]) - 1)
            own = np.where((ids[d][at] == key)[:, None], owns[d][at], 0.0)
            p = own * estimates[d][at] + (1 - own) * p
        return p

    @staticmethod
    def _logs(p):
        """log2 of the product of the eight bit probabilities, per byte."""
        out = np.zeros((len(p), 256))
        p = np.clip(p, 2.0**-50, 1 - 2.0**-50)
        byte = np.arange(256)
        for i in range(8):
            one = p[:, (1 << i) | (byte >> (8 - i))]
            out += np.log2(np.where((byte >> (7 - i)) & 1, one, 1 - one))
        return out.astype(np.float32)

    def table(self) -> None:
        """Direct-address table from a context to its row (in the worker)."""
        sizes = np.cumsum([0] + [len(r) for r in self.rows])
        self.flat = np.concatenate(self.rows)
        row = np.full(1 << 24, sizes[0], np.int32)
        every = np.arange(1 << 16, dtype=np.int64)
        two = np.full(1 << 16, sizes[0], np.int32)
        for d in (1, 2):
            lookup = np.full(1 << (8 * d), -1, np.int32)
            if len(self.ids[d]):
                lookup[self.ids[d]] = sizes[d] + np.arange(len(self.ids[d]), dtype=np.int32)
            got = lookup[every % (1 << (8 * d))]
            two = np.where(got >= 0, got, two)
        row.reshape(256, 1 << 16)[:] = two
        row[self.kept] = sizes[3] + np.arange(len(self.kept), dtype=np.int32)
        self.row, self.flat, self.first = row, self.flat.reshape(-1), sizes[3]

    def bits(self, text: bytes) -> tuple[float, list[np.ndarray]]:
        """Code length of ``text`` in bits; if the model is partial, also which
        (context, byte) cells took a shallower context, how often, and the bits
        that each time took."""
        total = 0.0
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        for at in range(0, len(text), 1 << 20):
            c, b = _codes(text[max(0, at - DEPTH) : at + (1 << 20)])
            skip = min(at, DEPTH)
            c, b = c[skip:], b[skip:]
            row = self.row[c].astype(np.int64)
            logs = self.flat[row * 256 + b]
            total -= float(logs.sum(dtype=np.float64))
            if self.partial:
                out = row < self.first
                cells, place, times = np.unique(c[out].astype(np.int64) * 256 + b[out], return_index=True, return_counts=True)
                found.append((cells, times, -logs[out][place]))
        return total, [np.concatenate(x) for x in zip(*found)]


def _rows(df: DataFrame) -> np.ndarray:
    got = df.toArrow()
    return np.column_stack([got.column(i).to_numpy().astype(np.float64) for i in range(got.num_columns)])


def _others(leaves: DataFrame, nodes: DataFrame, top: tuple) -> DataFrame:
    """(c, logs): log2 P(byte | c) for the deepest contexts of ``leaves``, made in
    groups of one two-byte context (256 deepest at most) with its ``nodes``."""
    shipped = leaves.sparkSession.sparkContext.broadcast(top)

    def estimate(group: pa.Table) -> pa.Table:
        two, c, node, zeros, ones, own = (group.column(i).to_numpy() for i in range(6))
        leaf = c >= 0
        contexts, row = np.unique(c[leaf], return_inverse=True)
        logs = np.zeros((0, 256), np.float32)
        if len(contexts):
            above = Model._nodes(np.column_stack([two, node, zeros, ones, own])[~leaf].astype(np.float64))
            ids, estimates, owns = ([*x, y] for x, y in zip(shipped.value, above))
            p = Model._leaves(len(contexts), row, node[leaf], ones[leaf])
            logs = Model._logs(Model._mixed(contexts, p, 2, ids, estimates, owns))
        return pa.table({"c": pa.array(contexts, pa.int64()), "logs": pa.array(list(logs), pa.list_(pa.float32()))})

    both = leaves.select(
        (F.col("c") % (1 << 16)).alias("two"), "c", F.col("b").alias("node"), F.lit(0).cast("long").alias("zeros"), F.col("n").alias("ones"), F.lit(0.0).alias("own")
    ).unionByName(
        nodes.select(F.col("c").alias("two"), F.lit(-1).cast("long").alias("c"), F.col("node").cast("long").alias("node"), "zeros", "ones", "own")
    )
    return both.groupBy("two").applyInArrow(estimate, "c long, logs array<float>")


def train(texts: DataFrame, contexts: int = 1 << 15) -> tuple[Model, DataFrame | None]:
    """``texts``: one binary column ``t``.  What comes to the driver is the model:
    at most ``contexts`` x 256 leaf counts and the nodes of depth 2 and less.
    Beside it the stored (c, logs) of all other deepest contexts, if any."""
    counted = texts.mapInArrow(count_contexts, "c long, b long, n long")
    leaves = stored(counted.groupBy("c", "b").agg(F.sum("n").alias("n")), "ctw-leaves")
    every = leaves.groupBy("c").agg(F.sum("n").alias("m"))
    top = frequent(every, contexts, "m").select("c")
    kept_rows = _rows(leaves.join(top, "c").select("c", "b", "n"))
    nodes = tree(leaves)
    levels = [_rows(x.select("c", "node", "zeros", "ones", "own")) for x in reversed(nodes)]
    kept = np.unique(kept_rows[:, 0].astype(np.int64)) if len(kept_rows) else np.zeros(0, np.int64)
    counts = kept_rows.astype(np.int64).reshape(-1, 3)
    if len(counts):
        counts[:, 0] = np.searchsorted(kept, counts[:, 0])
    model = Model(kept, levels, counts)
    model.partial = every.count() > len(kept)
    if not model.partial:
        return model, None
    return model, stored(_others(leaves.join(top, "c", "left_anti"), nodes[0], model.top), "ctw-others")


# ------------------------------------------------------------------- scoring

SCORED = (
    "key long, id long, held_out boolean, n_tokens long, n_bytes long, known long, logs double, "
    "rare array<binary>, times array<int>, bits double, cells array<long>, cell_times array<int>, cell_bits array<float>"
)
_WORKER: dict = {}


def _scorer(model, unigrams):
    """Scores batches of (key, id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("id") != model.value[0]:
            _WORKER.update(id=model.value[0], ctw=model.value[1], logs=unigrams.value)
            _WORKER["ctw"].table()
        ctw, logs = _WORKER["ctw"], _WORKER["logs"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = [[] for _ in range(10)]
                for text in part.column(3):
                    raw = text.as_py()
                    counts = Counter(tokens(raw))
                    counts[END] = 1
                    known, base, rare, times = 0, 0.0, [], []
                    for word, n in counts.items():
                        value = logs.get(word)
                        if value is None:
                            rare.append(word)
                            times.append(n)
                        else:
                            known += n
                            base += n * value
                    bits, cells = ctw.bits(raw)
                    for column, value in zip(out, (sum(counts.values()), len(raw), known, base, rare, times, bits, *cells)):
                        column.append(value)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.float64()]
                types += [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.float32())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), *(pa.array(c, t) for c, t in zip(out, types))],
                    names=[f.split()[0] for f in SCORED.split(", ")],
                )

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of each task, added up until 200,000 words are held."""
    held: Counter = Counter()

    def take():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["w", "n"]
        )
        held.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            held.update(tokens(text.as_py()))
            held[END] += 1
            if len(held) > 200_000:
                yield take()
    yield take()


def score(
    docs: DataFrame, modulus: int = 7, held: int = 2, contexts: int = 1 << 15, most: int = 1 << 17,
    text: str = "text", doc: str = "doc_id",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes, bits_per_byte), one row per row of ``docs``.  Learns from the rows
    whose crc32(id as text) mod ``modulus`` is not ``held``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc).cast("long").alias("id"),
        (fold(doc, modulus) == held).alias("held_out"),
        F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("t"),
    )
    train_text = rows.filter(~F.col("held_out")).select("t")
    model, others = train(train_text, contexts)
    words = stored(
        train_text.mapInArrow(_word_counts, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")), "lm-words"
    )
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent(words, most).select("w", "n").toArrow()
    share = math.log10(total + distinct + 1)
    logs = {w: math.log10(n + 1) - share for w, n in zip(top.column(0).to_pylist(), top.column(1).to_pylist())}
    sc = spark.sparkContext
    shipped, unigrams = sc.broadcast((f"{sc.applicationId}-{id(model)}-{total}-{distinct}", model)), sc.broadcast(logs)
    scored = stored(
        rows.select(F.monotonically_increasing_id().alias("key"), "id", "held_out", "t").mapInArrow(_scorer(shipped, unigrams), SCORED),
        "lm-scored",
    )
    rare = scored.select("key", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("key", "r.rare", "r.times")
    looked_up = (
        rare.join(words.select(F.col("w").alias("rare"), "n"), "rare", "left")
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - share)).alias("rare_logs"),
        )
    )
    known = F.col("known") + F.coalesce("rare_known", F.lit(0))
    out = scored.drop("rare", "times", "cells", "cell_times", "cell_bits").join(looked_up, "key", "left")
    bits = F.col("bits")
    if others is not None:
        cells = scored.select("key", F.explode(F.arrays_zip("cells", "cell_times", "cell_bits")).alias("r")).select(
            "key", F.shiftright("r.cells", 8).alias("c"), (F.col("r.cells") % 256).cast("int").alias("b"), "r.cell_times", "r.cell_bits"
        )
        deeper = (
            cells.join(others, "c")
            .groupBy("key")
            .agg(F.sum(F.col("cell_times") * (-F.get("logs", F.col("b")).cast("double") - F.col("cell_bits"))).alias("deeper"))
        )
        out, bits = out.join(deeper, "key", "left"), F.col("bits") + F.coalesce("deeper", F.lit(0.0))
    return out.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        known.cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("base_score"),
        (-bits * math.log10(2)).alias("score"),
        "n_bytes",
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).otherwise(0.0).alias("bits_per_byte"),
    )
