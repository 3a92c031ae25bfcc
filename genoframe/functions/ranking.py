"""Distributed ordinal ranks along a chromosome.

``row_number() over (partition by chrom order by pos)`` puts a whole
chromosome in one task.  These helpers split the chromosome into blocks of
the order key: a small per-block table (one row per block) carries the
offsets, and the row-level windows partition by (chrom, block), so the work
spreads over many tasks and only the block table is ever ordered globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1_000_000


def block_rank(
    df: DataFrame, part: str, order: str, out: str = "rank", block: int = DEFAULT_BLOCK, tiebreak: str | None = None
) -> DataFrame:
    """1-based ``row_number`` of ``order`` within ``part`` (ties by ``tiebreak``)."""
    blk = F.floor(F.col(order) / F.lit(block)).cast("bigint")
    d = df.withColumn("_blk", blk)
    counts = d.groupBy(part, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wb), F.lit(0))).drop("_n")
    keys = [order] + ([tiebreak] if tiebreak else [])
    wr = Window.partitionBy(part, "_blk").orderBy(*keys)
    return (
        d.join(offsets, [part, "_blk"])
        .withColumn(out, (F.col("_off") + F.row_number().over(wr)).cast("bigint"))
        .drop("_blk", "_off")
    )
