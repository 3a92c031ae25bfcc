"""Components of a graph that changes along an axis (inventory E4/E5).

An edge (strain1, strain2) exists on the ranks ``lo..hi``.  The ranks are cut
into blocks.  An edge enters only

* the one or two blocks that it covers in part, with its ranks there, and
* O(log) nodes of a binary tree over blocks that together are the blocks it
  covers whole.  The edges of a node are reduced to a spanning forest, at most
  one edge per strain, before they go down to its blocks.

A block is solved offline: its edges are handed down a binary tree over its
ranks, a union-find without path compression takes those that cover a tree node
and undoes them on the way back, and a subtree that no further edge enters has
one answer for all its ranks.  A block yields runs of ranks in which a strain's
component keeps its name, so rows come out per change, not per rank.  A task
holds at most (levels x strains) forest edges and the edges that begin or end in
the block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK_BITS = 10  # 1,024 ranks a block
TREE_LEVELS = 40
_FOREST = "chrom string, level int, node long, strain1 string, strain2 string"
_RUNS = "chrom string, strain string, first long, last long, component string"


class _Undo:
    """Union by size with undo; a root knows the smallest index of its set."""

    def __init__(self, n: int) -> None:
        self.parent, self.size, self.least, self.log = list(range(n)), [1] * n, list(range(n)), []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.log.append((b, self.least[a]))
        self.parent[b] = a
        self.size[a] += self.size[b]
        self.least[a] = min(self.least[a], self.least[b])
        return True

    def back_to(self, mark: int) -> None:
        while len(self.log) > mark:
            b, least = self.log.pop()
            a = self.parent[b]
            self.parent[b], self.least[a] = b, least
            self.size[a] -= self.size[b]

    def labels(self) -> np.ndarray:
        parent = np.array(self.parent)
        root = parent[parent]
        while not np.array_equal(root, parent):
            root, parent = root[root], root
        return np.array(self.least)[root]


def _numbered(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names, index = np.unique(np.concatenate([pdf.strain1, pdf.strain2]).astype(str), return_inverse=True)
    return names, index[: len(pdf)], index[len(pdf) :]


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    names, a, b = _numbered(pdf)
    sets = _Undo(len(names))
    return pdf[[sets.union(x, y) for x, y in zip(a.tolist(), b.tolist())]]


def _block_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    names, a, b = _numbered(pdf)
    lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
    own = np.arange(len(names))
    sets, out = _Undo(len(names)), []
    known, since = own.copy(), np.zeros(len(names), dtype=np.int64)

    def change(labels: np.ndarray, at: int) -> None:
        moved = np.flatnonzero(labels != known)
        ended = moved[known[moved] != own[moved]]
        if len(ended):
            out.append(pd.DataFrame({"strain": names[ended], "first": since[ended], "last": at - 1, "component": names[known[ended]]}))
        known[moved], since[moved] = labels[moved], at

    def visit(first: int, last: int, edges: np.ndarray) -> None:
        mark = len(sets.log)
        whole = (lo[edges] <= first) & (hi[edges] >= last)
        for e in edges[whole].tolist():
            sets.union(a[e], b[e])
        rest = edges[~whole]
        if len(rest) == 0:
            change(sets.labels(), first)
        else:
            middle = (first + last) // 2
            visit(first, middle, rest[lo[rest] <= middle])
            visit(middle + 1, last, rest[hi[rest] > middle])
        sets.back_to(mark)

    visit(int(lo.min()), int(hi.max()), np.arange(len(pdf)))
    change(own, int(hi.max()) + 1)
    runs = pd.concat(out) if out else pd.DataFrame(columns=["strain", "first", "last", "component"])
    return runs.assign(chrom=pdf["chrom"].iloc[0])[["chrom", "strain", "first", "last", "component"]]


def block_edges(edges: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``chrom, blk, strain1, strain2, lo, hi``: edges cut at the blocks, those
    that cover blocks whole as spanning forests of tree nodes."""
    size = 1 << bits
    lo, hi = F.col("lo"), F.col("hi")
    first, last = F.shiftright("lo", bits), F.shiftright("hi", bits)
    begins, ends = lo == first * size, hi == last * size + size - 1
    e = edges.withColumns({"_f": first, "_l": last, "_b": begins, "_e": ends})
    partial = F.filter(
        F.array(
            F.when(~(F.col("_b") & ((F.col("_f") < F.col("_l")) | F.col("_e"))), F.col("_f")),
            F.when((F.col("_f") < F.col("_l")) & ~F.col("_e"), F.col("_l")),
        ),
        lambda blk: blk.isNotNull(),
    )
    start = F.col("blk") * size
    parts = e.withColumn("blk", F.explode(partial)).select(
        "chrom", "blk", "strain1", "strain2", F.greatest(lo, start).alias("lo"), F.least(hi, start + size - 1).alias("hi")
    )
    # whole blocks [l, r): at level v the covering nodes are l_v if odd and r_v - 1 if r_v is odd
    l0 = F.when(F.col("_b"), F.col("_f")).otherwise(F.col("_f") + 1)
    r0 = F.when(F.col("_e"), F.col("_l") + 1).otherwise(F.col("_l"))
    e = e.withColumns({"_l0": l0, "_r0": r0}).filter(F.col("_l0") < F.col("_r0"))
    e = e.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(TREE_LEVELS - 1))))
    shifted = lambda x: F.call_function("shiftright", x, F.col("level"))
    e = e.withColumns({"_lv": -shifted(-F.col("_l0")), "_rv": shifted(F.col("_r0"))}).filter(F.col("_lv") < F.col("_rv"))
    cover = F.array(F.when(F.col("_lv") % 2 == 1, F.col("_lv")), F.when(F.col("_rv") % 2 == 1, F.col("_rv") - 1))
    nodes = e.withColumn("node", F.explode(F.filter(cover, lambda x: x.isNotNull())))
    nodes = nodes.select("chrom", "level", "node", "strain1", "strain2").dropDuplicates()
    forest = nodes.groupBy("chrom", "level", "node").applyInPandas(_forest, _FOREST)
    left = lambda x: F.call_function("shiftleft", x, F.col("level"))
    forest = forest.withColumn("blk", F.explode(F.sequence(left(F.col("node")), left(F.col("node") + 1) - 1)))
    whole = forest.select("chrom", "blk", "strain1", "strain2", start.alias("lo"), (start + size - 1).alias("hi"))
    return parts.unionByName(whole)


def component_runs(edges: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Runs ``chrom, strain, first, last, component`` of ranks in which the
    smallest name of a strain's component is another strain's; elsewhere a
    strain's component bears its own name.  ``edges``: ``chrom, strain1,
    strain2, lo, hi`` with ranks lo <= hi, repeats and overlaps allowed."""
    ship_package(edges.sparkSession)
    runs = block_edges(edges, bits).groupBy("chrom", "blk").applyInPandas(_block_runs, _RUNS)
    w = Window.partitionBy("chrom", "strain").orderBy("first")
    goes_on = (F.lag("component").over(w) == F.col("component")) & (F.lag("last").over(w) == F.col("first") - 1)
    runs = runs.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy("chrom", "strain", "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.first("component").alias("component")
    ).select("chrom", "strain", "first", "last", "component")
