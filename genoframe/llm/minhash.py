"""Near-duplicate documents by b-bit MinHash.

1. One pass hashes each document's distinct word shingles and keeps 128 minima.
   Their lowest two bits are packed into four longs; 32 bands of four whole
   minima give band keys (a pair of similarity 0.8 shares no band once in
   2 x 10^7 times).  Documents with the same shingle set (count, 64-bit sum and
   xor of its hashes) are one class; from here on only one row of a class takes
   part, under the hash of these three numbers.
2. Star candidates: per band key, every member is compared with two leaders
   (smallest id, smallest hash), not with every other member.
3. The estimated similarity comes from the count of equal two-bit fields,
   corrected for chance collisions: (m - 1/4) / (3/4).  Pairs below
   ``min_estimate`` go (5 standard deviations under the threshold), and so do
   pairs whose set sizes alone rule the threshold out.
4. The rest is confirmed on the full sets.
5. In ``rounds`` further turns, members outside the main component of a band
   key are compared with another leader of it, drawn anew for every key.
6. Members of one key that are still in different components are compared with
   each other (estimate first, then the full sets, all inside the join; each
   pair in one key only), so no link between different texts is lost.  Nothing is compared inside a
   component, and large groups are one component by then.

Components come from :mod:`components`; their nodes are classes, so rows that
repeat an id with different texts are compared one by one.  The document that
stays has the smallest id of its component.  Defined cases: null or empty text
has no shingles and is linked with nothing, an empty table gives an empty
result, a text shorter than the shingle is one shingle, rows that repeat id and
text are treated alike, null ids come after all others (among themselves by the
hash of their text).  Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import parted, small, text_of, without
from .components import components

HASHES, BANDS, BITS = 128, 32, 2
ROWS = HASHES // BANDS
MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.RandomState(7)
#: Multiply-add family on 64 bits; the upper half of the product is the value.
MULTIPLY = _RNG.randint(0, 2**63 - 1, HASHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _RNG.randint(0, 2**63 - 1, HASHES, dtype=np.int64).astype(np.uint64)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``."""
    words = text.lower().split()  # bytes: A-Z only, ASCII space only
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    known: dict[bytes, int] = {}
    ids = np.fromiter((known[w] if w in known else known.setdefault(w, digest(w)) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ ids[k : k + n]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(hashes: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), 2048):
        block = ((hashes[at : at + 2048, None] * MULTIPLY + ADD) >> np.uint64(32)).astype(np.uint32)
        np.minimum(best, block.min(axis=0), out=best)
    return best


def pack(best: np.ndarray) -> np.ndarray:
    """The low two bits of 128 minima in four longs."""
    fields = (best & np.uint32(3)).astype(np.uint64).reshape(4, 32)
    return np.bitwise_or.reduce(fields << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=1).view(np.int64)


def band_keys(best: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
    for column in best.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = (key ^ column) * MIX
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


SIGNED = "h long, n long, total long, folded long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                hashes = shingle_hashes(text.as_py() or b"", width)
                if not len(hashes):
                    rows.append((h, 0, 0, 0, 0, 0, 0, 0, []))
                    continue
                best = minima(hashes)
                total, folded = hashes.sum(dtype=np.uint64), np.bitwise_xor.reduce(hashes)
                rows.append(
                    (h, len(hashes), int(total.view(np.int64)), int(folded.view(np.int64)), *pack(best).tolist(), band_keys(best))
                )
            columns = list(zip(*rows)) if rows else [[]] * 9
            types = [pa.int64()] * 8 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc", *[f.split()[0] for f in SIGNED.split(", ")]],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), 256):  # small batches out: a set is as large as its text
                sets = [shingle_hashes(t.as_py() or b"", width).view(np.int64) for t in batch.column(1)[at : at + 256]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at : at + 256], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "items"]
                )

    return run


def estimate(left: str, right: str) -> Column:
    """Similarity from two packed signatures, corrected for fields equal by chance."""
    low = 0x5555555555555555
    differing = sum(
        F.bit_count(
            (F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))).bitwiseOR(
                F.shiftrightunsigned(F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}")), 1)
            ).bitwiseAND(F.lit(low))
        )
        for i in range(4)
    )
    chance = 1.0 / 2**BITS
    return ((HASHES - differing) / HASHES - chance) / (1 - chance)


def _plausible(left: str, right: str, percent: int, min_estimate: float) -> Column:
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (estimate(left, right) >= min_estimate)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").filter(_linked("x", "y", percent)).select("a", "b")


def _linked(x: str, y: str, percent: int) -> Column:
    """100 * intersection >= percent * union, for arrays without repeats."""
    both = F.size(F.array_intersect(x, y)).cast("long")
    return both * (100 + percent) >= (F.size(x) + F.size(y)) * percent


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    min_estimate: float = 0.6,
    rounds: int = 2,
    text: str = "text",
    doc: str = "doc_id",
) -> DataFrame:
    """(id, _h, n_shingles, component_id, kept, n_links): one row per distinct id and
    text (``_h`` is its hash); n_links counts confirmed links of the row's class."""
    source = docs.select(
        F.col(doc).alias("doc"), F.xxhash64(text_of(text)).alias("h"), F.encode(text_of(text), "UTF-8").alias("t")
    )
    kind = source.schema["doc"].dataType.simpleString()
    signed = stored(source.mapInArrow(_signatures(width), f"doc {kind}, {SIGNED}"), "mh-signed")
    rows, distinct = signed.agg(F.count("*"), F.count_distinct(F.struct("doc", "h"))).first()
    if rows > distinct:  # repeated rows
        signed = stored(signed.dropDuplicates(["doc", "h"]), "mh-signed")
    node = F.xxhash64("n", "total", "folded")
    same = stored(
        signed.filter("n > 0")
        .groupBy("n", "total", "folded")
        .agg(F.min("doc").alias("low"), F.min("h").alias("low_h"), F.min(F.struct("h", "doc")).alias("first"))
        .withColumn("rep", node),
        "mh-classes",
    )
    shape = ["id", "n", "s0", "s1", "s2", "s3"]
    firsts = same.select(F.col("rep").alias("id"), F.col("first.doc").alias("_d"), F.col("first.h").alias("_g"))
    own = F.col("doc").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_g"))
    reps = signed.join(firsts, own).select("id", "n", "s0", "s1", "s2", "s3", "bands")

    # band keys with two members or more
    keys = reps.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(
        F.count("*").alias("members"), F.min("id").alias("lead1"), F.min_by("id", F.xxhash64("id")).alias("lead2")
    ).filter("members > 1")
    members = stored(keys.join(shared, "key"), "mh-members")
    active = stored(
        reps.select(*shape, "bands").join(members.select("id").distinct(), "id", "left_semi"), "mh-active"
    )
    wanted = stored(firsts.join(active.select("id"), "id", "left_semi"), "mh-wanted")
    _, texts = parted(source, "h", wanted, "_g", "mh-bits")
    texts = texts.join(small(wanted), own).select("id", "t")
    if rows > distinct:
        texts = texts.dropDuplicates(["id"])
    sets = stored(texts.mapInArrow(_sets(width), "id long, items array<long>"), "mh-sets")

    stars = (
        members.select("id", F.explode(F.array("lead1", "lead2")).alias("lead"))
        .filter("id <> lead")
        .select(F.greatest("id", "lead").alias("a"), F.least("id", "lead").alias("b"))
        .distinct()
    )
    known = stored(_screened(stars, active, percent, min_estimate), "mh-stars")
    links = stored(confirm(known, sets, percent), "mh-links")

    # members of one key in different components: new leaders, another for each key
    for turn in range(rounds):
        rows, _ = _open(members, links)
        lead = rows.filter("label = main").groupBy("key").agg(F.min_by("id", F.xxhash64("id", "key", F.lit(turn))).alias("lead"))
        pairs = (
            rows.filter("label <> main")
            .join(lead, "key")
            .select(F.greatest("id", "lead").alias("a"), F.least("id", "lead").alias("b"))
            .distinct()
            .join(known, ["a", "b"], "left_anti")
        )
        tried = stored(_screened(pairs, active, percent, min_estimate), "mh-turn")
        found = stored(confirm(tried, sets, percent), "mh-found")
        known, links = known.union(tried), links.union(found)
        if found.isEmpty():
            break

    # what is still apart: every pair of one key, each in the first key it shares
    rows, labels = _open(members, links)
    rows = stored(rows.join(active, "id").join(sets, "id"), "mh-open")
    more = (
        rows.filter("label <> main").alias("l")
        .join(
            rows.alias("r"),
            (F.col("l.key") == F.col("r.key"))
            & (F.col("l.label") != F.col("r.label"))
            & ((F.col("r.label") == F.col("r.main")) | (F.col("l.id") < F.col("r.id")))
            & _plausible("l", "r", percent, min_estimate)
            & (F.array_min(F.array_intersect("l.bands", "r.bands")) == F.col("l.key"))
            & _linked("l.items", "r.items", percent),
        )
        .select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b"))
        .distinct()
    )
    more = stored(more, "mh-more")
    every = stored(links.union(more), "mh-every")
    final = stored(components(every) if not more.isEmpty() else labels, "mh-final")

    degree = every.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    classes = stored(
        same.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .join(degree, "rep", "left")
        .select("n", "total", "folded", "low", "low_h", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links")),
        "mh-labelled",
    )
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"), F.min("low_h").alias("least_h"))
    named = classes.join(lowest, "component").select("n", "total", "folded", "component_id", "least_h", "links")
    alone = F.col("n") == 0
    return signed.join(named, ["n", "total", "folded"], "left").select(
        F.col("doc").alias("id"),
        F.col("h").alias("_h"),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).when(F.col("component_id").isNull(), F.col("h") == F.col("least_h"))
        .otherwise(F.col("doc").eqNullSafe(F.col("component_id"))).alias("kept"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def _open(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, id, label, main): members of the keys of three members or more
    (two are compared already) that hold more than one component; ``main`` is
    the key's most frequent one.  And the components, (node, component)."""
    labels = components(links)
    named = members.filter("members > 2").join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("key", "id", F.coalesce("component", "id").alias("label")), "mh-named")
    sizes = named.groupBy("key", "label").agg(F.count("*").alias("c"))
    top = (
        sizes.groupBy("key")
        .agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels"))
        .filter("labels > 1")
        .drop("labels")
    )
    return stored(named.join(top, "key"), "mh-mixed-keys"), labels


def _screened(pairs: DataFrame, active: DataFrame, percent: int, min_estimate: float) -> DataFrame:
    shape = [c for c in active.columns if c != "bands"]
    left = active.select(F.struct(*shape).alias("l"))
    right = active.select(F.struct(*shape).alias("r"))
    return (
        pairs.join(left, F.col("a") == F.col("l.id"))
        .join(right, F.col("b") == F.col("r.id"))
        .filter(_plausible("l", "r", percent, min_estimate))
        .select("a", "b")
    )


def deduplicate(docs: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that another one of their group replaces."""
    gone = near_duplicates(docs, text=text, doc=doc, **options).filter(~F.col("kept")).select(F.col("id").alias("_doc"), "_h")
    return without(docs, stored(gone, "mh-gone"), text, doc)
