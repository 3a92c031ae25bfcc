"""Phrase collocations by SON partitioning.

Words are the runs between spaces and tabs of the pieces between sentence
punctuation and line ends, A-Z lower-cased; everything is counted per language.
A phrase of ``shortest`` to ``longest`` words is frequent if it occurs
``support`` times or more, overlaps included.

1. One pass turns each text into 64-bit word hashes (the language is part of
   the hash), 0 between pieces, counts the words of every language, and deals
   the input's partitions to ``shards`` shards.
2. Mining: the local support of a shard is ``support`` times its share of the
   language, so that a frequent phrase reaches it in at least one shard.  The
   number of shards is fixed: local support does not fall, and candidates do not
   multiply, as the corpus grows.  A shard is a grouping key, not a task.  Not
   phrases are counted but their hashes cut to 26 bits, two bytes and a count
   each: a cut hash is counted for every phrase that has it, so that none is missed.
3. United are the cut hashes that reach their support in some shard and
   ``support`` over all shards of all languages.
4. Counting: all occurrences of phrases with such a hash are counted by their
   whole hash; the sums are exact, and what stays below ``support`` goes.

Words and both counts travel in blocks: a row holds what a piece of text has in
one of a fixed number of ranges of hashes, and a task adds up one range at a time.

Steps 2 to 4 run for pairs first and for the longer lengths afterwards, since
only a place whose pairs are all frequent can hold a longer frequent phrase.
Between the steps tasks receive bitmaps of 2^24 or 2^26 bits (8 MB) that never
miss a phrase; the exact sets stay distributed and are joined.

Score: the lowest of floor(scale * a * n / (l * r)) over all cuts in two, in
128-bit decimals.  A phrase inside a longer frequent one that occurs as often
is dropped.  The words of the leading phrases are spelled from the texts at the
end; until then only hashes move.

Words and phrases are told apart by 64-bit hashes.  Defined cases: null text is
empty, a null language counts as ``und``, an empty table gives an empty result,
repeated rows count again, a very long text is cut into parts that overlap by
``longest`` - 1 words, so that no phrase is lost or counted twice.  Other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

from . import bits

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Ends of pieces become line feeds; then every end is a word of its own.
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
END = b"\xff"  # in no UTF-8 text
PART = 128  # words of a row; tasks receive 10,000 rows at a time
LOG_BITS = 24
CUT_BITS = 26  # of a hash that mining looks at
RANGE_BITS = 16  # of them, those that one row tells apart
SUM_BITS = 8  # of a hash, its range in the exact counts

ENCODED = "lang string, ids binary, own int, bucket int, keys binary, n binary"
SCHEMA = pa.schema([("lang", pa.string()), ("ids", pa.binary()), ("own", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _hashes(words: list[bytes], seed: int) -> np.ndarray:
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words))
    keys[keys == 0] = 1
    keys[keys == np.uint64(xxhash.xxh3_64_intdigest(END, seed))] = 0
    return keys


def _tokens(text: bytes) -> list[bytes]:
    return text.lower().translate(BREAKS).replace(b"\n", b" \xff ").split()


def _encode(longest: int, flush: int = 1 << 19):
    over = longest - 1

    def counted(lang: str, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        keys, counts = keys[keys > 0], counts[keys > 0]
        block = _blocks(_ends(keys, 64, SUM_BITS), {"keys": keys, "n": counts.astype(np.uint32)})
        m = block.num_rows
        if m:
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, m), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int32()), *block.columns], schema=SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for batch in _small(batches):
            langs, ids, own = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = _hashes(_tokens(text.as_py()), _seed(lang))
                if not len(keys):
                    continue
                for at in range(0, len(keys), PART):
                    langs.append(lang)
                    ids.append(keys[at : at + PART + over].tobytes())
                    own.append(min(PART, len(keys) - at))
                held.setdefault(lang, []).append(keys)
                size[lang] = size.get(lang, 0) + len(keys)
                if size[lang] >= flush:
                    yield from counted(lang, held.pop(lang))
                    size.pop(lang)
            m = len(langs)
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(ids, pa.binary()), pa.array(own, pa.int32()),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], schema=SCHEMA
                )
        for lang in list(held):
            yield from counted(lang, held.pop(lang))

    return run


def _spell(needed):
    """(key, word) of the words whose bit is set, each once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for batch in _small(batches):
            found: dict[int, str] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = _tokens(text.as_py())
                keys = _hashes(words, _seed(lang))
                for at in np.flatnonzero(bits.test(needed.value, keys)).tolist():
                    key = int(keys[at])
                    if key not in told:
                        told.add(key)
                        found[key] = words[at].decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(list(found), np.uint64).view(np.int64)), pa.array(list(found.values()), pa.string())], names=["key", "word"]
            )

    return run


def _small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def joined(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one word more."""
    out = (key ^ (word * MIX)) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(31))


class Shard:
    """Words of one shard: ``ids`` with 0 between pieces, and where the parts'
    own words are (a phrase that starts on another word belongs to the next part)."""

    def __init__(self, parts: list[tuple[bytes, int, int]]):
        size = sum(len(b) // 8 + 1 for b, _, _ in parts)
        self.ids, self.own, at = np.zeros(size, np.uint64), np.zeros(size, bool), 0
        self.starts, self.parts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        while parts:  # each part goes as it is copied
            b, own, part = parts.pop()
            self.ids[at : at + len(b) // 8] = np.frombuffer(b, np.uint64)
            self.own[at : at + own] = True
            i = len(self.parts) - len(parts) - 1
            self.starts[i], self.parts[i] = at, part
            at += len(b) // 8 + 1

    def spots(self, at: np.ndarray) -> np.ndarray:
        """Where the own words at these places are in the corpus: part and word in it."""
        i = np.searchsorted(self.starts, at, "right") - 1
        return self.parts[i] * PART + (at - self.starts[i])

    def runs(self, frequent: np.ndarray) -> np.ndarray:
        """Places of words that may be frequent."""
        at = np.flatnonzero(self.ids)
        return at[bits.test(frequent, self.ids[at])]

    def longer(self, at: np.ndarray, key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of phrases of ``size`` words, from the places and
        hashes of those of one word less: both ends must be among them."""
        mark = np.zeros(len(self.ids) + 1, bool)
        mark[at] = True
        keep = mark[at + 1]
        at = at[keep]
        return at, joined(key[keep], self.ids[at + size - 1])


def _gathered(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[str, int, Shard]]:
    """Pieces of one language and shard, and of one partition as it was written.
    What a task holds is bounded by about twice ``words``, however many languages
    and shards it meets."""
    held: dict[tuple[str, int, int], list[tuple[bytes, int, int]]] = {}
    size: dict[tuple[str, int, int], int] = {}
    total = 0
    for batch in _small(batches):
        for lang, ids, own, shard, part in zip(*(c.to_pylist() for c in batch.columns)):
            place = (lang, shard, part >> 33)  # see monotonically_increasing_id
            held.setdefault(place, []).append((ids, own, part))
            size[place] = size.get(place, 0) + own
            total += own
            if size[place] >= words or total >= 2 * words:
                if size[place] < words:
                    place = max(size, key=size.__getitem__)
                total -= size.pop(place)
                yield *place[:2], Shard(held.pop(place))
    for place in list(held):
        yield *place[:2], Shard(held.pop(place))


def _phrases(piece: Shard, frequent, pairs, lengths: tuple[int, ...], among) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, hashes) of the phrases of ``lengths`` whose words, and
    pairs if given, may be frequent and which may be ``among`` the given ones,
    as their ends must be."""
    at = piece.runs(frequent.value)
    key = piece.ids[at]
    for size in range(2, lengths[-1] + 1):
        at, key = piece.longer(at, key, size)
        for table in (pairs if size == 2 else None, among if size in lengths else None):
            if table is not None:
                keep = bits.test(table.value, key)
                at, key = at[keep], key[keep]
        if size in lengths and len(at):
            own = piece.own[at]
            yield size, at[own], key[own]


def _ends(keys: np.ndarray, size: int, ranges: int) -> np.ndarray:
    """Where the 2^``ranges`` equal ranges of ``size``-bit values end in the sorted keys."""
    limits = np.arange(1, 1 << ranges, dtype=np.uint64) << np.uint64(size - ranges)
    return np.append(np.searchsorted(keys, limits), len(keys))


def _blocks(ends: np.ndarray, blobs: dict[str, np.ndarray], **same: pa.Scalar) -> pa.RecordBatch:
    """A row (bucket, *blobs, *same) for each range of the sorted values that holds
    any; range i ends before the place ``ends[i]``."""
    starts = np.concatenate([[0], ends[:-1]])
    some = np.flatnonzero(ends > starts)
    at = np.append(starts[some], len(next(iter(blobs.values())))).astype(np.int32)
    columns = {"bucket": pa.array(some.astype(np.int32))}
    for name, values in blobs.items():
        buffers = [None, pa.py_buffer(at * np.int32(values.itemsize)), pa.py_buffer(np.ascontiguousarray(values))]
        columns[name] = pa.Array.from_buffers(pa.binary(), len(some), buffers)
    for name, value in same.items():
        columns[name] = pa.repeat(value, len(some))
    return pa.RecordBatch.from_pydict(columns)


MINED = "bucket int, low binary, n binary, place int"
COUNTED = "bucket int, keys binary, n binary, spots binary, base long"


def _mine(places: dict[tuple[str, int], int], support: int, frequent, pairs, lengths: tuple[int, ...], words: int):
    """Counts of cut hashes by ``place``, a language's shard; up to ``support`` in a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard, piece in _gathered(batches, words):
            parts = [key for _, _, key in _phrases(piece, frequent, pairs, lengths, None)]
            if parts:
                found, n = np.unique(np.concatenate(parts) & np.uint64((1 << CUT_BITS) - 1), return_counts=True)
                blobs = {"low": found.astype(np.uint16), "n": np.minimum(n, support).astype(np.min_scalar_type(support))}
                yield _blocks(_ends(found, CUT_BITS, CUT_BITS - RANGE_BITS), blobs, place=pa.scalar(places[lang, shard], pa.int32()))

    return run


def _reach(needs: list[int], support: int):
    """The bits of the cut hashes of one range that reach the local support of
    some place, and ``support`` in all."""

    def run(block: pa.Table) -> pa.Table:
        total, reached = np.zeros(1 << RANGE_BITS, np.int64), np.zeros(1 << RANGE_BITS, bool)
        places, low, n = block.column("place").to_numpy(), block.column("low"), block.column("n")
        for place in np.unique(places).tolist():
            here = np.zeros(1 << RANGE_BITS, np.int64)
            for i in np.flatnonzero(places == place).tolist():  # no hash occurs twice in a row
                here[np.frombuffer(low[i].as_py(), np.uint16)] += np.frombuffer(n[i].as_py(), np.min_scalar_type(support))
            reached |= here >= needs[place]
            total += here
        reached &= total >= support
        return pa.table({"bucket": block.column("bucket").slice(0, 1), "bits": [np.packbits(reached, bitorder="little").tobytes()]})

    return run


def _candidates(mined: DataFrame, needs: list[int], support: int):
    """A bitmap of the candidates for the tasks."""
    out = np.zeros(1 << (CUT_BITS - 6), np.uint64)
    size = 1 << (RANGE_BITS - 6)
    for row in mined.groupBy("bucket").applyInArrow(_reach(needs, support), "bucket int, bits binary").toArrow().to_pylist():
        out[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(row["bits"], np.uint64)
    return mined.sparkSession.sparkContext.broadcast(out)


def _count(frequent, pairs, candidates, lengths: tuple[int, ...], words: int):
    """Counts by whole hash, and one spot where each phrase is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, piece in _gathered(batches, words):
            parts = [(at, key) for _, at, key in _phrases(piece, frequent, pairs, lengths, candidates) if len(key)]
            if parts:
                at, key = (np.concatenate(x) for x in zip(*parts))
                found, first, n = np.unique(key, return_index=True, return_counts=True)
                spots = piece.spots(at[first])
                base = int(spots.min())
                spots = (spots - base).astype(np.uint32 if spots.max() - base < 1 << 32 else np.uint64)
                blobs = {"keys": found, "n": n.astype(np.uint32), "spots": spots}
                yield _blocks(_ends(found, 64, SUM_BITS), blobs, base=pa.scalar(base, pa.int64()))

    return run


def _words(block: pa.Table) -> pa.Table:
    """(key, lang, n) of one range of one language's words."""
    keys = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in block.column("keys")])
    n = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in block.column("n")]).astype(np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return pa.table({"key": keys[starts], "lang": pa.repeat(block.column("lang")[0], len(starts)), "n": np.add.reduceat(n[order], starts)})


def _sum(support: int):
    """(key, a, spot) of one range: the phrases that occur ``support`` times or more."""

    def run(block: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in block.column("keys")])
        n = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in block.column("n")]).astype(np.int64)
        spots = []
        for b, m, base in zip(block.column("spots"), block.column("n"), block.column("base").to_pylist()):
            wide = len(b.as_py()) > len(m.as_py())
            spots.append(np.frombuffer(b.as_py(), np.uint64 if wide else np.uint32).astype(np.int64) + base)
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        a = np.add.reduceat(n[order], starts)
        spot = np.minimum.reduceat(np.concatenate(spots)[order], starts)
        keep = a >= support
        return pa.table({"key": keys[starts][keep], "a": a[keep], "spot": spot[keep]})

    return run


def _scattered(spots: np.ndarray) -> list[np.ndarray]:
    """Two independent keys of each spot, for two bitmaps."""
    some = spots.view(np.uint64)
    return [joined(some, np.full(len(some), salt, np.uint64)) for salt in (1, 2)]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = _scattered(batch.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["one", "two"])


def _show(frequent, pairs, chosen, spots, lengths: tuple[int, ...], words: int):
    """The words of the chosen phrases at the chosen spots (and at the few spots that
    share a bit with one of them in both bitmaps)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, piece in _gathered(batches, words):
            for size, at, key in _phrases(piece, frequent, pairs, lengths, chosen):
                spot = piece.spots(at)
                here = np.logical_and(*(bits.test(b.value, k) for b, k in zip(spots, _scattered(spot))))
                at, key, spot = at[here], key[here], spot[here]
                for cut in range(0, len(key), 1 << 15):
                    some = slice(cut, cut + (1 << 15))
                    rows = piece.ids[at[some][:, None] + np.arange(size)].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[some].view(np.int64)), pa.array(spot[some]), pa.array([lang] * len(rows)),
                         pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, size, dtype=np.int32)), pa.array(rows.ravel()))],
                        names=["key", "spot", "lang", "ids"],
                    )

    return run


PARTS = "key long, lang string, a long, ids array<long>, lefts array<long>, rights array<long>, inner array<long>"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of both sides of every cut, and of all shorter phrases inside."""

    def key_of(words: list[int]) -> int:
        out = np.array(words[:1], np.int64).view(np.uint64)
        for w in words[1:]:
            out = joined(out, np.array([w], np.int64).view(np.uint64))
        return int(out.view(np.int64)[0])

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            some = batch.slice(at, 4096)
            lefts, rights, inner = [], [], []
            for ids in some.column(3).to_pylist():
                m = len(ids)
                lefts.append([key_of(ids[:k]) for k in range(1, m)])
                rights.append([key_of(ids[k:]) for k in range(1, m)])
                inner.append([key_of(ids[i : i + k]) for k in range(2, m) for i in range(m - k + 1)])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (lefts, rights, inner)]
            yield pa.RecordBatch.from_arrays([*some.columns, *lists], names=[f.split()[0] for f in PARTS.split(", ")])


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("t"),
    )


def _broadcast(keys: DataFrame, log_bits: int = LOG_BITS):
    """A bitmap of the column ``key`` for the tasks."""
    return keys.sparkSession.sparkContext.broadcast(bits.as_array(bits.bitmap(keys, "key", log_bits), log_bits))


def frequent_phrases(
    docs: DataFrame, support: int, longest: int, shards: int, piece_words: int, text: str, lang: str
) -> tuple[DataFrame, DataFrame]:
    """(key, lang, ids, a) of all frequent phrases, and (key, lang, n) of all words."""
    encoded = _source(docs, text, lang).mapInArrow(_encode(longest), ENCODED).withColumn("shard", F.spark_partition_id() % shards)
    encoded = encoded.withColumn("part", F.monotonically_increasing_id())
    encoded = stored(encoded, "phrase-ids", "zstd")  # hashes repeat as their words do
    counted = encoded.filter("ids IS NULL").select("lang", "bucket", "keys", "n")
    words = stored(counted.groupBy("lang", "bucket").applyInArrow(_words, "key long, lang string, n long"), "phrase-words")
    rows = encoded.filter("ids IS NOT NULL").select("lang", "ids", "own", "shard", "part")
    sizes = {(r.lang, r.shard): r.n for r in rows.groupBy("lang", "shard").agg(F.sum("own").alias("n")).collect()}  # langs x shards
    totals: dict[str, int] = {}
    for (name, _), n in sizes.items():
        totals[name] = totals.get(name, 0) + n
    places = {place: i for i, place in enumerate(sizes)}
    needs = [-(-support * n // totals[name]) for (name, _), n in sizes.items()]  # rounded up

    frequent, pairs, out = _broadcast(words.filter(F.col("n") >= support)), None, None
    for lengths in [(2,), tuple(range(3, longest + 1))]:
        if not lengths:
            break
        mined = rows.mapInArrow(_mine(places, support, frequent, pairs, lengths, piece_words), MINED)
        candidates = _candidates(mined, needs, support)
        counted = rows.mapInArrow(_count(frequent, pairs, candidates, lengths, piece_words), COUNTED)
        exact = stored(counted.groupBy("bucket").applyInArrow(_sum(support), "key long, a long, spot long"), "phrase-counts")
        chosen = _broadcast(exact)
        marks = exact.select("spot").mapInArrow(_marks, "one long, two long")
        spots = [_broadcast(marks.select(F.col(c).alias("key"))) for c in ("one", "two")]
        shown = rows.mapInArrow(
            _show(frequent, pairs, chosen, spots, lengths, piece_words), "key long, spot long, lang string, ids array<long>"
        )
        found = stored(exact.join(shown, ["key", "spot"]).select("key", "lang", "ids", "a"), "phrases")
        out = found if out is None else out.unionByName(found)
        pairs = chosen
    return out, words


def collocations(
    docs: DataFrame,
    support: int = 100,
    longest: int = 5,
    top: int = 2000,
    scale: int = 1000,
    shards: int = 16,
    piece_words: int = 1 << 19,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of
    2 to ``longest`` words by score, then a (descending), then phrase."""
    found, words = frequent_phrases(docs, support, longest, shards, piece_words, text, lang)
    split = stored(found.select("key", "lang", "a", "ids").mapInArrow(_parts, PARTS), "phrase-parts")
    counts = words.select("key", "n").union(split.select("key", "a"))
    inside = split.select(F.explode("inner").alias("key"), F.col("a").alias("b")).groupBy("key").agg(F.max("b").alias("b"))
    kept = split.join(inside, "key", "left").filter("b IS NULL OR 100 * b < 100 * a").drop("b", "inner")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = kept.select("key", "lang", "a", "ids", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    cuts = (
        cuts.join(counts.select(F.col("key").alias("_l"), F.col("n").alias("l")), F.col("cut.lefts") == F.col("_l"))
        .join(counts.select(F.col("key").alias("_r"), F.col("n").alias("r")), F.col("cut.rights") == F.col("_r"))
        .join(F.broadcast(total), "lang")  # one row a language
    )
    wide = lambda c: f"cast({c} as decimal(18, 0))"
    score = F.expr(f"(cast({scale} * a as decimal(18, 0)) * {wide('n')}) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("key").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"),
        *[F.first(c).alias(c) for c in ("lang", "a", "n", "ids")],
    )
    flat = best.select("key", "lang", "a", "n", "ids", "best.score", "best.l", "best.r")
    ahead = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    leading = stored(flat.withColumn("_rank", F.rank().over(ahead)).filter(F.col("_rank") <= top), "phrase-leading")  # ties included
    places = leading.select("key", F.posexplode("ids").alias("i", "w"))
    needed = _broadcast(places.select(F.col("w").alias("key")), 22)
    spelling = _source(docs, text, lang).mapInArrow(_spell(needed), "key long, word string").distinct()
    spelled = (
        places.join(stored(spelling, "phrase-spelling").select(F.col("key").alias("w"), "word"), "w")
        .groupBy("key")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        leading.join(spelled, "key")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
      FROM w, unnest(range(1, 6)) g(k), unnest(range(1, len(w) - k + 2)) h(i) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
i AS (SELECT lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, max(a) AS b
      FROM c, unnest(range(2, 5)) g(m), unnest(range(1, k - m + 2)) h(s) WHERE m < k GROUP BY ALL),
d AS (SELECT c.* FROM c LEFT JOIN i ON c.lang = i.lang AND c.phrase = i.phrase WHERE b IS NULL OR 100 * b < 100 * a),
x AS (SELECT d.lang, d.phrase, d.a, j, l.f AS l, r.f AS r, n.n,
             CAST((CAST(1000 AS HUGEINT) * d.a * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM d JOIN n ON n.lang = d.lang CROSS JOIN unnest(range(1, 5)) g(j)
      JOIN f l ON l.lang = d.lang AND l.k = j AND l.phrase = array_to_string(d.w[1 : j], ' ')
      JOIN f r ON r.lang = d.lang AND r.k = d.k - j AND r.phrase = array_to_string(d.w[j + 1 : d.k], ' ')
      WHERE j < d.k),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM y)
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000
"""
