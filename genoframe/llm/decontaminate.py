"""Benchmark decontamination by a positional inverted index.

Words: maximal runs of digits, a-z (A-Z lower-cased) and characters beyond
ASCII.  A window is ``window`` consecutive words of an item, or all words of a
shorter item.

1. Corpus frequencies of the words that occur in the items.
2. The two rarest words of every window are its anchors.  The index stores the
   postings (word, document, position) of all anchor words.
3. Offset-adjusted intersection: a posting of an anchor at offset o of an item
   says that the item would start at position - o.  Documents, items and starts
   at which both anchors of some window agree are candidates; one candidate
   covers all windows of the item there.
4. Each candidate is compared word by word with its document; runs of at least
   a window's length are exact phrase matches.

:func:`proximity_matches` uses the same postings, but lets the two anchors of a
window stand up to ``slop`` words apart from their places.

Tables of words and anchors come from the items alone; they are broadcast only
after a count, and joined by shuffle beyond it.  Only documents that may hold a
candidate are shuffled with their words.  A frequent passage costs one row per
occurrence.  Defined cases: null text has no words; items without words
or without an id take no part, items that repeat an id count as one; rows that
repeat id and text are treated alike, an empty table gives an empty result (and
no hits without items); extra columns are kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import ascii_lower, is_small, keyed, parted, small, text_of, without

#: Everything that is not a word character.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["_doc", "_h"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def _same_doc(left: str, right: str) -> Column:
    return F.col(f"{left}._doc").eqNullSafe(F.col(f"{right}._doc")) & (F.col(f"{left}._h") == F.col(f"{right}._h"))


def item_table(items: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """(_i, item_id, _iw): a number, the id and the words of each distinct item."""
    rows = items.filter(F.col(item).isNotNull()).select(
        F.col(item).cast("string").alias("item_id"), words_of(text_of(text)).alias("_iw")
    )
    return rows.filter(F.size("_iw") > 0).distinct().withColumn("_i", F.xxhash64("item_id", "_iw"))


def frequencies(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n) over ``docs`` (keyed) for the words of ``vocabulary``."""
    corpus = docs.select(F.explode(words_of(F.col("_text"))).alias("word"))
    if is_small(vocabulary):
        return corpus.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    return corpus.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word")


def anchor_table(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(_i, start, word, offset, other): per window its two rarest words, each
    with the offset of the other one (its own in a one-word item)."""
    placed = items.select("_i", F.size("_iw").alias("_n"), F.posexplode("_iw").alias("offset", "word"))
    placed = placed.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    last = F.greatest(F.col("_n") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("offset") - (window - 1), F.lit(0)), F.least("offset", last))
    ranked = placed.withColumn("start", F.explode(starts)).withColumn(
        "r", F.row_number().over(W.partitionBy("_i", "start").orderBy("n", "offset"))
    )
    two = ranked.filter("r <= 2")
    pair = two.groupBy("_i", "start").agg(F.min("offset").alias("a"), F.max("offset").alias("b"))
    return two.join(pair, ["_i", "start"]).select(
        "_i", "start", "word", "offset", F.when(F.col("offset") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("other")
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (word, _doc, _h, pos) for the words of ``terms``."""
    tokens = docs.select(*DOC, F.posexplode(words_of(F.col("_text"))).alias("pos", "word"))
    return tokens.join(small(terms), "word")


class Index:
    """Items, their anchors and the stored postings of the anchor words."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = 10):
        self.docs, self.window = docs, window
        self.items = stored(items, "items")
        vocabulary = stored(self.items.select(F.explode("_iw").alias("word")).distinct(), "item-words")
        counts = stored(frequencies(docs, vocabulary), "item-word-counts")
        self.anchors = stored(anchor_table(self.items, counts, window), "anchors")
        terms = stored(self.anchors.select("word").distinct(), "anchor-words")
        self.postings = stored(postings(docs, terms), "postings")

    def adjusted(self) -> DataFrame:
        """(_doc, _h, _i, offset, at): where each posting would put its item."""
        places = stored(self.anchors.select("_i", "word", "offset").distinct(), "anchor-places")
        return self.postings.join(small(places), "word").select(*DOC, "_i", "offset", (F.col("pos") - F.col("offset")).alias("at"))

    def candidates(self) -> DataFrame:
        """(_doc, _h, _i, at) at which both anchors of a window agree."""
        offsets = self.adjusted().groupBy(*DOC, "_i", "at").agg(F.collect_set("offset").alias("_o"))
        pairs = self.anchors.groupBy("_i").agg(F.collect_set(F.struct("offset", "other")).alias("_pairs"))
        agree = F.exists(
            "_pairs", lambda p: F.array_contains(F.col("_o"), p["offset"]) & F.array_contains(F.col("_o"), p["other"])
        )
        return offsets.join(small(stored(pairs, "anchor-pairs")), "_i").filter(agree).select(*DOC, "_i", "at")


def phrase_matches(index: Index) -> DataFrame:
    """(_doc, _h, n_words, hits, found): per document the positions inside any
    occurrence of a window, and the ids of the items that occur (sorted)."""
    near = (
        index.candidates()
        .join(small(index.items), "_i")
        .groupBy(*DOC)
        .agg(F.collect_set(F.struct("item_id", "at", "_iw")).alias("_c"))
    )
    near = stored(near, "candidates")
    certain, possible = parted(index.docs, "_h", near, "_h", "candidate-bits")
    docs = possible.select(*DOC, words_of(F.col("_text")).alias("_w")).alias("d")
    joined = docs.join(near.alias("c"), _same_doc("d", "c"), "left").select("d.*", "c._c")

    def occurrences(c: Column) -> Column:
        need = F.least(F.size(c["_iw"]), F.lit(index.window))
        same = F.transform(c["_iw"], lambda w, i: F.when(F.get(F.col("_w"), c["at"] + i) == w, "1").otherwise("0"))
        line = F.array_join(same, "")
        starts = F.filter(
            F.sequence(F.lit(0), F.size(c["_iw"]) - need), lambda s: line.substr(s + 1, need) == F.repeat(F.lit("1"), need)
        )
        hits = F.flatten(F.transform(starts, lambda s: F.sequence(c["at"] + s, c["at"] + s + need - 1)))
        return F.struct(c["item_id"].alias("item_id"), hits.alias("hits"))

    found = F.filter(F.transform("_c", occurrences), lambda x: F.size(x["hits"]) > 0)
    met = joined.withColumn("_f", found).select(
        *DOC,
        F.size("_w").cast("long").alias("n_words"),
        F.array_distinct(F.flatten("_f.hits")).alias("hits"),
        F.array_sort(F.array_distinct("_f.item_id")).alias("found"),
    )
    kinds = {f.name: f.dataType for f in met.schema.fields}
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in ("hits", "found")]
    return met.union(certain.select(*DOC, F.size(words_of(F.col("_text"))).cast("long").alias("n_words"), *none))


def proximity_matches(index: Index, slop: int = 5) -> DataFrame:
    """(_doc, _h, item_id, at, apart): windows whose two anchors stand within
    ``slop`` words of their places relative to each other."""
    pairs = index.anchors.filter("offset < other").select("_i", "offset", "other").distinct()
    adjusted = index.adjusted()
    left = adjusted.join(pairs, ["_i", "offset"]).alias("l")
    right = adjusted.alias("r")
    apart = F.abs(F.col("l.at") - F.col("r.at"))
    return (
        left.join(
            right,
            _same_doc("l", "r") & (F.col("l._i") == F.col("r._i")) & (F.col("l.other") == F.col("r.offset")) & (apart <= slop),
        )
        .groupBy(F.col("l._doc").alias("_doc"), F.col("l._h").alias("_h"), F.col("l._i").alias("_i"), F.col("l.at").alias("at"))
        .agg(F.min(apart).alias("apart"))
        .join(index.items.select("_i", "item_id"), "_i")
        .select(*DOC, "item_id", "at", "apart")
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(_doc, _h, n_words, n_hit, n_items, found) per row of ``docs``."""
    index = Index(keyed(docs, text, doc), item_table(items), window)
    return phrase_matches(index).select(
        *DOC,
        "n_words",
        F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("found", F.array().cast("array<string>")).alias("found"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    hit = decontaminate(docs, items, text=text, doc=doc, **options).filter("n_hit > 0").select(*DOC).distinct()
    return without(docs, stored(hit, "contaminated"), text, doc)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
n AS (SELECT item_id, least(len(w), 10) AS k, w FROM i WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS phrase FROM n, unnest(range(1, len(w) - k + 2)) g(s)),
t AS (SELECT DISTINCT d.doc_id, s, kk.k, array_to_string(d.w[s : s + kk.k - 1], ' ') AS phrase
      FROM d, (SELECT DISTINCT k FROM p) kk, unnest(range(1, len(d.w) - kk.k + 2)) g(s)),
m AS (SELECT t.doc_id, t.s, t.k, p.item_id FROM t JOIN p ON t.k = p.k AND t.phrase = p.phrase),
h AS (SELECT doc_id, CAST(count(DISTINCT x) AS BIGINT) AS n_hit FROM m, unnest(range(s, s + k)) g(x) GROUP BY doc_id),
f AS (SELECT doc_id, CAST(count(DISTINCT item_id) AS BIGINT) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN f ON d.doc_id = f.doc_id
"""
