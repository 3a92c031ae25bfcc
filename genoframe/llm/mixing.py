"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id.  A source that should give
``need`` words takes the documents whose hash is below a threshold.  The
threshold is found by nested histograms, without a sort: sum the sizes by
(source, top 12 hash bits), find the bucket in which the running sum passes
``need``, then repeat inside that one bucket with the next 12 bits.  Only the
boundary bucket is read again, and the histogram of a source never has more
than 4,096 rows, however hot the source is.

Defined cases: null text has size 0, an empty table gives an empty result, a
null source is a source of its own (ordered last), rows that repeat an id
share its hash and are taken together or not at all, a null id hashes as
empty text.  A source whose documents are all empty has target 0.  Extra
columns are kept by :func:`mix`; its own columns win over equally named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import packed, small, text_of

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12


def hash60(column: str) -> Column:
    """First 15 hex digits of md5(id as text) as a number of 60 bits."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), fraction: float = 1.5, max_repeats: int = 2
) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Weights repeat over the sources in code point order, null last.  The
    budget ``fraction`` x all sizes is shared by weight; a target stops at
    ``max_repeats`` x its source's size and the excess goes to the others.
    Solved by its water level: in order of cap / weight, the level before a
    source is (budget - caps so far) / (weights left), and the source is
    capped if that is above its own ratio.  One row per source: the windows
    hold the list of sources, not documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = totals.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("_w"),
        (F.lit(float(max_repeats)) * F.col("source_size")).alias("_cap"),
    )
    everything = W.partitionBy()
    before = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    level = ranked.withColumn(
        "_level",
        (F.lit(fraction) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))),
    ).withColumn("_capped", F.col("_level") > F.col("_cap") / F.col("_w"))
    water = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)
    return level.select(
        "source",
        "source_size",
        F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least("_cap", water * F.col("_w"))).alias("target"),
    )


def thresholds(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """(source, threshold): documents with ``hash < threshold`` hold the words
    nearest to ``need``.

    ``rows``: (source, size, hash); ``needs``: (source, need), one per source.
    """
    state = stored(needs.select("source", "need", F.lit(0).cast("long").alias("prefix")), "mix-need")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftrightunsigned("hash", shift)
        s = small(state.withColumnRenamed("source", "_s"))
        inside = rows.filter(F.col("size") > 0).join(
            s,
            F.col("source").eqNullSafe(F.col("_s"))
            & (F.shiftrightunsigned("hash", shift + LEVEL_BITS) == F.col("prefix")),
        )
        hist = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"),
            F.first("need").alias("need"),
            F.min("hash").alias("lo"),
            F.max("hash").alias("hi"),
        )
        upto = F.sum("words").over(
            W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        )
        passing = (
            hist.withColumn("upto", upto)
            .filter(F.col("upto") > F.col("need"))
            .groupBy("source")
            .agg(F.min_by(F.struct("bucket", "words", "need", "upto", "lo", "hi"), "bucket").alias("b"))
            .select(
                "source",
                (F.col("b.need") - (F.col("b.upto") - F.col("b.words"))).alias("need"),
                F.col("b.bucket").alias("prefix"),
                F.col("b.words").alias("words"),
                F.col("b.lo").alias("lo"),
                F.col("b.hi").alias("hi"),
            )
        )
        state = stored(passing, "mix-boundary")
        if state.filter(F.col("lo") < F.col("hi")).isEmpty():
            break  # every boundary bucket holds one hash
        state = state.select("source", "need", "prefix", "words", "lo", "hi")
    return state.select(
        "source", F.when(F.col("need") >= F.col("words") / 2, F.col("hi") + 1).otherwise(F.col("lo")).alias("threshold")
    )


def mix(docs: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", **plan) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words, repeats
    counted).  A document is taken floor(target / source_size) times, and once
    more if its hash is below the threshold of the source's rest."""
    own = ("size", "source_size", "target", "taken")
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    sized = packed(docs, source=F.col(source), size=size, hash=hash60(doc))
    rows = stored(sized.select("source", "size", "hash"), "mix-sizes")
    goal = stored(targets(rows, **plan), "mix-targets")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    needs = goal.select("source", (F.col("target") - full * F.col("source_size")).alias("need"))
    cut = stored(thresholds(rows, needs), "mix-thresholds")
    by_source = goal.withColumn("_full", full).select(F.col("source").alias("_s"), "source_size", "target", "_full")
    limit = cut.select(F.col("source").alias("_c"), "threshold")
    by_source = stored(
        by_source.join(limit, F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c"), "mix-plan"
    )
    taken = F.col("size") * (F.col("_full") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0))
    return (
        sized.join(small(by_source), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("taken", taken.cast("long"))
        .select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in own], *own)
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
      FROM s),
l AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0))
        / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER o, 0)) AS lev
      FROM w WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
        CASE WHEN lev > cap / w THEN cap
             ELSE least(cap, w * (SELECT max(lev) FROM l WHERE lev <= cap / w)) END AS target FROM l),
g AS (SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS fulls,
        sum(size) OVER (PARTITION BY d.source, h) AS tied,
        sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (fulls + CASE WHEN target - fulls * source_size - (upto - tied) >= tied / 2 THEN 1 ELSE 0 END) AS BIGINT)
    AS taken
FROM g
"""
