"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component): smallest node reachable, for each node of ``edges``
    (a, b).  A star round replaces a node's edges by edges to its smallest
    neighbour; the minimum per node is a map-side combined aggregate and goes
    back by a join, so no neighbour list is ever gathered.  Each round is
    written to the shared folder.  Ends when all that is left are stars: no
    node has two smaller neighbours, and no smaller neighbour has one itself."""
    now = stored(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct(),
        "cc-edges",
    )
    for _ in range(max_rounds):
        if _stars(now):
            roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        # large star: neighbours above a node move to the node's minimum
        large = (
            both.join(low, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        )
        large = stored(large.filter("u < v"), "cc-large")
        # small star: neighbours below a node move to the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small_star = (
            large.join(least, "v")
            .select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
            .select("e.v", "e.u")
            .filter("u < v")
            .distinct()
        )
        now = stored(small_star, "cc-small")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _stars(edges: DataFrame) -> bool:
    roles = edges.select(F.col("v").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(
        edges.select(F.col("u").alias("x"), F.lit(0).alias("low"), F.lit(1).alias("high"))
    )
    both = roles.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return both.filter("low > 1 OR (low > 0 AND high > 0)").isEmpty()
