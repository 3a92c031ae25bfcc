"""Overlap joins over nested genomic bins.

A level has bins ``2**FANOUT_BITS`` times as long as those of the level below.
An interval's own level is the finest whose bins are at least as long as the
interval, so it touches at most two bins there and at most two of every coarser
level: the rows it takes are bounded by the number of levels, however long it
is.  Two intervals that overlap share a bin at the coarser of their own levels.
``side`` says whose own level that is, which keeps the join a plain equi-join
on (chromosome, level, bin, side): intervals that are both far below a level
never meet in its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_BITS = 10  # bins of 1,024 bases at the finest level
FANOUT_BITS = 3
LEVELS = 8  # the coarsest bins hold 2 G bases


def own_level(start: Column, end: Column) -> Column:
    """Finest level whose bins are at least as long as [start, end)."""
    out = F.lit(LEVELS - 1)
    for level in reversed(range(LEVELS - 1)):
        out = F.when(end - start <= 1 << (BASE_BITS + FANOUT_BITS * level), level).otherwise(out)
    return out


def _bin(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x.cast("bigint"), (level * FANOUT_BITS + BASE_BITS).cast("int"))


def bins_at(start: Column, end: Column, levels: Column, side: int) -> Column:
    """Array of (level, bin, side) that [start, end) touches at ``levels``."""
    last = F.greatest(end - 1, start)
    at = lambda v: F.transform(
        F.sequence(_bin(start, v), _bin(last, v)),
        lambda b: F.struct(v.alias("level"), b.alias("bin"), F.lit(side).alias("side")),
    )
    return F.flatten(F.transform(levels, at))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, Column, Column],
    right_span: tuple[str, Column, Column],
) -> DataFrame:
    """Every pair of overlapping half-open intervals once.

    A span is (chromosome column, start, end).  ``right`` should be the smaller
    table: its levels are looked up so that rows of ``left`` go only to levels
    that ``right`` uses.  Column names of the two must differ; rows with a null
    chromosome, start or end pair with nothing.
    """
    (lc, ls, le), (rc, rs, re) = left_span, right_span
    a = left.withColumns({"_s": ls, "_e": le}).withColumn("_own", own_level(F.col("_s"), F.col("_e")))
    b = right.withColumns({"_rs": rs, "_re": re}).withColumn("_rown", own_level(F.col("_rs"), F.col("_re")))
    used = b.agg(F.collect_set("_rown")).scalar()  # at most LEVELS numbers
    a = a.withColumn("_used", used)
    s, e, own = F.col("_s"), F.col("_e"), F.col("_own")
    left_bins = F.concat(
        bins_at(s, e, F.array(own), 0), bins_at(s, e, F.filter("_used", lambda v: v > F.col("_own")), 1)
    )
    a = a.withColumn("_k", F.explode(left_bins)).select(*left.columns, "_s", "_e", "_k.*")
    s, e, own = F.col("_rs"), F.col("_re"), F.col("_rown")
    right_bins = F.concat(
        bins_at(s, e, F.sequence(own, F.lit(LEVELS - 1)), 0), bins_at(s, e, F.array(own), 1)
    )
    b = b.withColumn("_k", F.explode(right_bins)).select(
        *right.columns, "_rs", "_re", F.col("_k.level").alias("_rlevel"), F.col("_k.bin").alias("_rbin"), F.col("_k.side").alias("_rside")
    )
    pairs = a.join(
        b,
        (F.col(lc) == F.col(rc))
        & (F.col("level") == F.col("_rlevel"))
        & (F.col("bin") == F.col("_rbin"))
        & (F.col("side") == F.col("_rside"))
        & (F.col("_s") < F.col("_re"))
        & (F.col("_rs") < F.col("_e"))
        & (_bin(F.greatest("_s", "_rs"), F.col("level")) == F.col("bin")),
    )
    return pairs.select(*left.columns, *right.columns)
