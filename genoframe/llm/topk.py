"""Exact top-k inner-product search: one ball tree per shard, branch and bound.

Vectors are dealt over shards by a hash of their id; a shard has about
``shard_rows`` of them, so its tree fits a task.  A node with centre c and
radius r bounds the score of all its vectors with a query q by
q.c + |q| r.  Each query visits the leaves in the order of their bounds and
stops at the first one under its current kth score.

The kth score is shared in two rounds: first every shard visits only the best
leaf of each query and the kth best of all those scores becomes the query's
floor; then every shard searches with that floor from the start.

Queries go to every shard in blocks of ``query_rows``; a task holds one shard
and one block.  Scores are integers: floor(256 x) per component, summed in
floating point where that is exact and in 64-bit integers otherwise.

Defined cases: vectors that are null or empty or hold a null, NaN or infinite
component, or have no id, take no part; rows that repeat an id count once, with
the smallest vector; vectors of different lengths are never compared; a query
never meets its own id; ties go to the smaller id; fewer than k candidates give
fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

PACKED = "vec_id long, dim int, v binary"
FOUND = "query_id long, vec_id long, score long"
LIMIT = 2.0**62


def _pack(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for vec, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if vec is None or not values or None in values:
                    continue
                x = np.asarray(values, np.float64)
                if np.isfinite(x).all():
                    whole = np.clip(np.floor(scale * x), -LIMIT, LIMIT).astype(np.int64)
                    ids.append(vec), dims.append(len(x)), packed.append(whole.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "v"]
            )

    return run


class BallTree:
    """Nodes over ``points``, re-ordered so that each node is a slice."""

    def __init__(self, points: np.ndarray, leaf: int = 128):
        self.order, self.nodes = np.arange(len(points)), []
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            own = points[self.order[start:end]]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            at = len(self.nodes)
            split = end - start > leaf and away.max() > 0
            self.nodes.append((start, end, parent, not split or None))
            if at == 0:
                self.centres, self.radii = [], []
            self.centres.append(centre)
            self.radii.append(away.max() * (1 + 1e-9))
            if split:
                far = own[away.argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                half = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argpartition(own @ (other - far), half)]
                todo += [(start, start + half, at), (start + half, end, at)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def leaf_bounds(self, queries: np.ndarray, floor: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Slices of the leaves and, per query, their bounds; -inf below a node
        whose bound is under the query's floor."""
        bounds = queries @ self.centres.T + np.sqrt((queries**2).sum(axis=1))[:, None] * self.radii
        bounds += 1e-9 * np.abs(bounds) + 1e-6
        leaves = []
        for at, (start, end, parent, is_leaf) in enumerate(self.nodes):  # parents come first
            if parent >= 0:
                bounds[bounds[:, parent] == -np.inf, at] = -np.inf
            bounds[bounds[:, at] < floor, at] = -np.inf
            if is_leaf:
                leaves.append(at)
        return [self.nodes[at][:2] for at in leaves], bounds[:, leaves]


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int,
    first_leaf_only: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), each queries x k; an unused place has the id -1."""
    exact = np.abs(vectors).max(initial=0).astype(float) * np.abs(queries).max(initial=0) * vectors.shape[1] < 2**53
    points = vectors.astype(np.float64)
    tree = BallTree(points)
    ids, points, whole = ids[tree.order], points[tree.order], vectors[tree.order]
    fq = queries.astype(np.float64)
    slices, bounds = tree.leaf_bounds(fq, floor)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    lowest = np.iinfo(np.int64).min
    scores = np.full((len(queries), k), lowest, np.int64)
    found = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
    live = np.arange(len(queries))
    for step in range(1 if first_leaf_only else len(slices)):
        leaf = turn[live, step]
        bound = bounds[live, leaf]
        kth = scores[live, k - 1]
        go = (bound > -np.inf) & ((bound >= kth) | (kth == lowest))
        live, leaf = live[go], leaf[go]
        if not len(live):
            break
        for one in np.unique(leaf):
            who = live[leaf == one]
            a, b = slices[one]
            got = (fq[who] @ points[a:b].T).astype(np.int64) if exact else queries[who] @ whole[a:b].T
            also = np.broadcast_to(ids[a:b], got.shape)
            own = also == query_ids[who][:, None]
            got, also = np.where(own, lowest, got), np.where(own, np.iinfo(np.int64).max, also)
            got, also = np.hstack([scores[who], got]), np.hstack([found[who], also])
            best = np.lexsort((also, -got.astype(np.float64)) if exact else (also, ~got), axis=-1)[:, :k]
            scores[who], found[who] = np.take_along_axis(got, best, 1), np.take_along_axis(also, best, 1)
    return scores, np.where(found == np.iinfo(np.int64).max, -1, found)


def _task(k: int, first_leaf_only: bool):
    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        read = lambda f: np.frombuffer(b"".join(f["v"]), np.int64).reshape(len(f), -1)
        qid = block["vec_id"].to_numpy(np.int64)
        floor = block["floor"].to_numpy(np.float64)
        scores, found = search(shard["vec_id"].to_numpy(np.int64), read(shard), qid, read(block), floor, k, first_leaf_only)
        row, place = np.nonzero(found >= 0)
        return pd.DataFrame({"query_id": qid[row], "vec_id": found[row, place], "score": scores[row, place]})

    return run


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, shard_rows: int = 8192, query_rows: int = 8192,
    vector: str = "embedding", vec: str = "vec_id",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose
    id is divisible by ``every``."""
    packed = stored(vectors.select(F.col(vec).cast("long"), F.col(vector)).mapInArrow(_pack(scale), PACKED), "topk-packed")
    rows, distinct = packed.agg(F.count("*"), F.count_distinct("vec_id")).first()
    if distinct < rows:
        packed = packed.groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("x")).select("vec_id", "x.dim", "x.v")
        packed, rows = stored(packed, "topk-packed"), distinct
    queries = packed.filter(F.col("vec_id") % every == 0)
    shards = max(1, -(-rows // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    place, turn = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    held = packed.withColumn("shard", place).withColumn("block", copies(blocks))
    keys = ["dim", "shard", "block"]

    def round_of(floors: DataFrame, first_leaf_only: bool) -> DataFrame:
        asked = floors.withColumn("block", turn).withColumn("shard", copies(shards))
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_task(k, first_leaf_only), FOUND)

    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    tried = stored(round_of(queries.withColumn("floor", F.lit(float("-inf"))), True), "topk-first")
    kth = tried.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor")
    )
    floors = stored(queries.join(kth, "vec_id", "left").fillna(float("-inf"), ["floor"]), "topk-floors")
    return (
        round_of(floors, False)
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE = r"""
WITH e AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
