"""Greedy pruning of linked sites in blocks of windows (inventory B21, E1).

Windows of ``window`` ranks start every ``step`` ranks; edges (linked pairs) are
visited by window, then by rank, and an edge of which both sites are still kept
removes its victim.  What one window decides depends on the windows before it,
but only through the sites that both hold: a block of windows needs to know which
of less than ``window`` sites at its head the block before has removed.

All blocks are solved at once with an empty head.  Blocks whose head turns out
different from the one they were solved with are solved again, until no head
changes.  Block k is right after k rounds at the latest; linkage that does not
reach through a whole block settles after one or two.  A task holds the edges of
one block, a number set by ``window`` and ``block``, not by how far linkage
reaches along the chromosome.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, stored

KEYS = ["ld", "chrom", "blk"]
EDGES_PER_BLOCK = 1 << 20
_SOLVED = "ld double, chrom string, blk long, head array<bigint>, removed array<bigint>"


def first_window(a: Column, b: Column, window: int, step: int) -> Column:
    """Start of the first window that holds the ranks a < b; null if none does."""
    start = F.ceil(F.greatest(b - window, F.lit(0)) / step) * step + 1
    return F.when(start <= a, start)


def _solve(edges: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    head = [int(r) for r in heads["head"].iloc[0]]
    gone, removed = set(head), []
    ordered = edges.sort_values(["w", "a", "b"])
    for a, b, victim in zip(ordered["a"].tolist(), ordered["b"].tolist(), ordered["victim"].tolist()):
        if a not in gone and b not in gone:
            gone.add(victim)
            removed.append(victim)
    out = heads[KEYS].copy()
    out["head"], out["removed"] = [head], [sorted(removed)]
    return out


def _solved(edges: DataFrame, heads: DataFrame) -> DataFrame:
    return edges.groupBy(*KEYS).cogroup(heads.groupBy(*KEYS)).applyInPandas(_solve, _SOLVED)


def greedy_removals(edges: DataFrame, window: int, step: int, block: int | None = None) -> DataFrame:
    """Removed ranks ``ld, chrom, rank`` for edges ``ld, chrom, a, b, victim``
    with ranks a < b of which victim is one.  ``block`` is the number of ranks
    whose windows form a block (at least ``window``)."""
    span = -(-max(window, block or EDGES_PER_BLOCK // window) // step) * step
    w = first_window(F.col("a"), F.col("b"), window, step)
    edges = edges.withColumn("w", w.cast("bigint")).filter(F.col("w").isNotNull())
    edges = materialize(edges.select("ld", "chrom", F.floor((F.col("w") - 1) / span).cast("bigint").alias("blk"), "w", "a", "b", "victim"))
    none = F.array().cast("array<bigint>")
    solved = materialize(_solved(edges, edges.select(*KEYS).distinct().withColumn("head", none)))
    while True:
        heads = solved.select("ld", "chrom", (F.col("blk") + 1).alias("blk"), "removed")
        heads = heads.select(*KEYS, F.filter("removed", lambda r: r > F.col("blk") * span).alias("_head"))
        stale = solved.join(heads, KEYS, "left").withColumn("_head", F.coalesce("_head", none))
        stale = materialize(stale.filter(F.col("_head") != F.col("head")).select(*KEYS, F.col("_head").alias("head")))
        if stale.isEmpty():
            return solved.select("ld", "chrom", F.explode("removed").alias("rank"))
        again = _solved(edges.join(stale.select(*KEYS), KEYS, "left_semi"), stale)
        solved = materialize(solved.join(stale.select(*KEYS), KEYS, "left_anti").unionByName(again))


# --------------------------------------------------------- forward filter
_KEPT = "chrom string, blk long, head array<bigint>, kept array<bigint>"
RANKS_PER_BLOCK = 8192


class _Rows:
    """Dosages with their calls, squares and sums, to take r^2 of one row with many."""

    def __init__(self, dosages: np.ndarray):
        self.called = (dosages >= 0).astype(np.float64)  # -1 = missing
        self.x = np.where(dosages >= 0, dosages, 0.0)
        self.xx = self.x * self.x

    def linked(self, row: int, others: np.ndarray, above: float) -> bool:
        """Whether ``row`` has an r^2 over ``above``, over pairwise-complete calls, with any of ``others``."""
        c, x, xx = self.called[others], self.x[others], self.xx[others]
        c1, x1 = self.called[row], self.x[row]
        n, sx, sy = c @ c1, x @ c1, c @ x1
        vx, vy, cov = n * (xx @ c1) - sx * sx, n * (c @ self.xx[row]) - sy * sy, n * (x @ x1) - sx * sy
        some = (vx > 0) & (vy > 0)
        return bool((cov[some] * cov[some] / (vx[some] * vy[some]) > above).any())


def _forward(window: int, above: float, span: int):
    def run(sites: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        blk, head = int(heads["blk"].iloc[0]), [int(r) for r in heads["head"].iloc[0]]
        sites = sites.sort_values("rank", ignore_index=True)
        rank = sites["rank"].to_numpy()
        first = blk * span + 1
        rows = _Rows(np.array(sites["dos"].tolist(), dtype=np.float64))
        kept = np.searchsorted(rank, np.array(sorted(head), dtype=np.int64)).tolist()
        low = 0  # the first of ``kept`` that is still within the window
        before = len(kept)
        for at in range(int(np.searchsorted(rank, first)), len(rank)):
            while low < len(kept) and rank[kept[low]] <= rank[at] - window:
                low += 1
            if low == len(kept) or not rows.linked(at, np.array(kept[low:]), above):
                kept.append(at)
        out = heads[["chrom", "blk"]].copy()
        out["head"], out["kept"] = [head], [[int(r) for r in rank[kept[before:]]]]
        return out

    return run


def forward_kept(ranked: DataFrame, window: int, above: float, span: int | None = None) -> DataFrame:
    """Ranks ``chrom, rank`` that stay if a site goes when its r^2 with an earlier
    kept site less than ``window`` ranks away exceeds ``above``: the greedy removal
    with step 1 and the later site as victim.  A site is compared with kept sites
    only, so no table of linked pairs is made.

    ``ranked`` is a stored table ``chrom, rank, dos`` (-1 = missing).  Blocks of
    ``span`` ranks are solved as above: from an empty head, then again as long as
    the sites that the block before keeps among its last ``window`` differ."""
    span = max(window, span or RANKS_PER_BLOCK)
    blk = F.floor((F.col("rank") - 1) / span).cast("bigint")
    late = F.pmod(F.col("rank") - 1, F.lit(span)) >= span - window + 1  # in reach of the next block
    copies = F.when(late, F.array(blk, blk + 1)).otherwise(F.array(blk))
    sites = ranked.select("chrom", "rank", "dos", F.explode(copies).alias("blk"))
    own = ranked.select("chrom", blk.alias("blk")).distinct()
    none = F.array().cast("array<bigint>")

    def solve(heads: DataFrame) -> DataFrame:
        some = sites.join(heads.select("chrom", "blk"), ["chrom", "blk"], "left_semi")
        both = some.groupBy("chrom", "blk").cogroup(heads.groupBy("chrom", "blk"))
        return stored(both.applyInPandas(_forward(window, above, span), _KEPT), "fwd-kept")

    solved = solve(stored(own.withColumn("head", none), "fwd-stale"))
    while True:
        heads = solved.select("chrom", (F.col("blk") + 1).alias("blk"), "kept")
        heads = heads.select("chrom", "blk", F.filter("kept", lambda r: r > F.col("blk") * span - window + 1).alias("_head"))
        stale = solved.join(heads, ["chrom", "blk"], "left").withColumn("_head", F.coalesce("_head", none))
        stale = stored(stale.filter(F.col("_head") != F.col("head")).select("chrom", "blk", F.col("_head").alias("head")), "fwd-stale")
        if stale.isEmpty():
            return solved.select("chrom", F.explode("kept").alias("rank"))
        rest = solved.join(stale.select("chrom", "blk"), ["chrom", "blk"], "left_anti")
        solved = stored(rest.unionByName(solve(stale)), "fwd-kept")
