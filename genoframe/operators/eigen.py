"""Leading eigenpairs of a relationship matrix that no task holds.

A block Lanczos iteration with restarts asks for products A Q with a narrow
block Q (samples x axes) only.  Spark computes them: every task multiplies its
share of the matrix, or of the genotypes it is made of, and keeps one
samples x axes partial for each problem; the partials are summed by a grouped
aggregate.  The driver sees samples x axes numbers a round and works on
factors of that size; the basis grows to ``wide`` blocks at most before it is
restarted.

Several problems (one for each LD threshold of a sweep) run in lockstep: one
pass over the genotypes serves all that have not converged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genotype as G
from ..session import stored

Blocks = dict[int, np.ndarray]
Product = Callable[[Blocks], Blocks]


@dataclass
class Problem:
    """A symmetric matrix of order ``n`` whose leading ``k`` pairs are wanted."""

    n: int
    k: int


class _Lanczos:
    """One problem: feed it A times ``block`` until ``done``."""

    def __init__(self, problem: Problem, spare: int, wide: int, tol: float, seed: int):
        self.n, self.k = problem.n, min(problem.k, problem.n)
        self.width, self.tol = min(self.n, self.k + spare), tol
        self.cap = max(2 * self.width, wide * self.width)
        start = np.random.RandomState(seed).standard_normal((self.n, self.width))
        self.block = np.linalg.qr(start)[0]
        self.basis, self.image = np.empty((self.n, 0)), np.empty((self.n, 0))
        self.done = False

    def feed(self, product: np.ndarray) -> None:
        self.basis, self.image = np.hstack([self.basis, self.block]), np.hstack([self.image, product])
        small = self.basis.T @ self.image
        values, turn = np.linalg.eigh((small + small.T) / 2)  # of the projection, at most ``cap`` wide
        values, turn = values[::-1], turn[:, ::-1]
        lead, image = self.basis @ turn[:, : self.width], self.image @ turn[:, : self.width]
        rest = image - lead * values[: self.width]
        errors = np.linalg.norm(rest[:, : self.k], axis=0)
        if self.basis.shape[1] >= self.n or (errors <= self.tol * max(abs(values[0]), 1e-300)).all():
            self.values, self.vectors, self.done = values[: self.k], lead[:, : self.k], True
            return
        if self.basis.shape[1] + self.width > self.cap:  # restart from the Ritz vectors
            self.basis, self.image = lead, image
        fresh = self._outside(rest)
        if not fresh.shape[1]:  # an invariant subspace: go on from anywhere outside
            fresh = self._outside(np.random.RandomState(self.basis.shape[1]).standard_normal((self.n, self.width)))
        self.block = fresh[:, : self.n - self.basis.shape[1]]

    def _outside(self, vectors: np.ndarray) -> np.ndarray:
        """An orthonormal basis of what ``vectors`` add to the basis."""
        out = vectors / np.maximum(np.linalg.norm(vectors, axis=0), 1e-300)
        for _ in range(2):
            out = out - self.basis @ (self.basis.T @ out)
            left, size, _ = np.linalg.svd(out, full_matrices=False)
            out = left[:, size > 1e-10 * max(size[0], 1e-300)] if size.size and size[0] > 1e-10 else left[:, :0]
        return out


def leading(
    problems: dict[int, Problem], product: Product, spare: int = 8, wide: int = 6, tol: float = 1e-10, rounds: int = 200, seed: int = 3
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(eigenvalues, eigenvectors as columns) of every problem, largest first;
    each vector's largest entry is positive.  ``product`` maps the open blocks
    to their products in one Spark job."""
    states = {key: _Lanczos(p, spare, wide, tol, seed) for key, p in problems.items() if p.n > 0}
    for _ in range(rounds):
        open_ = {key: s.block for key, s in states.items() if not s.done}
        if not open_:
            break
        for key, image in product(open_).items():
            states[key].feed(image)
    if any(not s.done for s in states.values()):
        raise RuntimeError(f"eigenpairs did not settle in {rounds} rounds")
    out = {}
    for key, s in states.items():
        peak = s.vectors[np.abs(s.vectors).argmax(axis=0), np.arange(s.vectors.shape[1])]
        out[key] = s.values, s.vectors * np.where(peak < 0, -1.0, 1.0)
    return out


# --------------------------------------------------------------- products
PARTIAL = "key int, i int, c int, v double"


def _rows(key: int, block: np.ndarray, first: int = 0) -> pa.RecordBatch:
    n, b = block.shape
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n * b, key, np.int32)),
            pa.array(np.repeat(np.arange(first, first + n, dtype=np.int32), b)),
            pa.array(np.tile(np.arange(b, dtype=np.int32), n)),
            pa.array(block.ravel()),
        ],
        names=["key", "i", "c", "v"],
    )


def _summed(partials: DataFrame) -> dict[int, list[tuple[int, int, float]]]:
    """The sums, per key; samples x axes rows each."""
    out: dict[int, list] = {}
    for r in partials.groupBy("key", "i", "c").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.key, []).append((r.i, r.c, r.v))
    return out


def matrix_product(pairs: DataFrame, index: dict[str, int]) -> Product:
    """A Q for the matrix given by the rows (strain1, strain2, grm), each pair once."""

    def run(blocks: Blocks) -> Blocks:
        (key, q), n = next(iter(blocks.items())), len(index)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n, q.shape[1]))
            for batch in batches:
                i, j = (np.array([index[s] for s in batch.column(c).to_pylist()], np.int64) for c in (0, 1))
                v = batch.column(2).to_numpy()[:, None]
                np.add.at(total, i, v * q[j])
                other = i != j
                np.add.at(total, j[other], v[other] * q[i[other]])
            yield _rows(key, total)

        image = np.zeros((n, q.shape[1]))
        for i, c, v in _summed(pairs.select("strain1", "strain2", "grm").mapInArrow(part, PARTIAL)).get(key, []):
            image[i, c] = v
        return {key: image}

    return run


def site_chunks(geno: DataFrame, tags: DataFrame | None = None, chunk: int = 1024) -> tuple[DataFrame, list[str]]:
    """Genotypes as stored chunks (dosages, tags) of about ``chunk`` sites, spread
    by a hash of the site, and the strains in the order of the columns.

    ``dosages`` holds one byte per site and strain (-1 = missing), ``tags`` one
    long per site: the problems whose site it is (bit by bit), 1 without
    ``tags`` (site_id, tag)."""
    strains = [r.strain for r in geno.select("strain").distinct().collect()]  # one name a sample
    strains.sort()
    calls = geno.select("site_id", "strain", G.dosage("gt").cast("tinyint").alias("g"))
    per_site = calls.groupBy("site_id").agg(F.map_from_entries(F.collect_list(F.struct("strain", "g"))).alias("_m"))
    names = F.array(*[F.lit(s) for s in strains]) if strains else F.array().cast("array<string>")
    dense = F.transform(names, lambda s: F.coalesce(F.element_at("_m", s), F.lit(-1).cast("tinyint")))
    per_site = per_site.select("site_id", dense.alias("dos"))
    if tags is None:
        per_site = per_site.withColumn("tag", F.lit(1).cast("bigint"))
    else:
        per_site = per_site.join(tags.select("site_id", "tag"), "site_id")
    per_site = stored(per_site, "pca-sites")
    count = max(1, -(-per_site.count() // chunk))
    spread = F.pmod(F.xxhash64("site_id"), F.lit(count)).cast("int")
    chunks = per_site.groupBy(spread.alias("chunk")).agg(F.flatten(F.collect_list("dos")).alias("dosages"), F.collect_list("tag").alias("tags"))
    return stored(chunks.select("dosages", "tags"), "pca-chunks"), strains


def _normalised(dosages: np.ndarray) -> np.ndarray:
    """z of each site (row) over the strains given; missing is 0."""
    called = dosages >= 0
    n, s = called.sum(axis=1), np.where(called, dosages, 0).sum(axis=1)
    p = (1 + s) / (2 + 2 * n)
    mean = np.divide(s, n, out=np.zeros(len(s)), where=n > 0)
    z = (dosages - mean[:, None]) / np.sqrt(p * (1 - p))[:, None]
    return np.where(called, z, 0.0)


def chunk_product(chunks: DataFrame, n: int, active: dict[int, np.ndarray], totals: dict[int, tuple[float, float]]) -> Product:
    """Z'(Z Q) / sites for each problem, from the stored chunks; ``active`` are the
    strains of a problem.  Puts (sites, trace) of each problem into ``totals``."""

    def run(blocks: Blocks) -> Blocks:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {key: np.zeros_like(q) for key, q in blocks.items()}
            sums = {key: np.zeros((1, 2)) for key in blocks}
            for batch in batches:
                for row in range(batch.num_rows):
                    flat = batch.column(0)[row].values.to_numpy(zero_copy_only=False)
                    tags = batch.column(1)[row].values.to_numpy(zero_copy_only=False)
                    dosages = flat.reshape(len(tags), n)
                    for key, q in blocks.items():
                        z = _normalised(dosages[(tags >> key) & 1 == 1][:, active[key]].astype(np.float64))
                        total[key] += z.T @ (z @ q)
                        sums[key] += [[len(z), np.square(z).sum()]]
            for key in blocks:
                yield _rows(key, total[key])
                yield _rows(key, sums[key], first=-1)

        out: Blocks = {}
        rows = _summed(chunks.mapInArrow(part, PARTIAL))
        for key, q in blocks.items():
            image, head = np.zeros_like(q), [0.0, 0.0]
            for i, c, v in rows.get(key, []):
                if i < 0:
                    head[c] = v
                else:
                    image[i, c] = v
            sites = max(head[0], 1.0)
            totals[key] = head[0], head[1] / sites
            out[key] = image / sites
        return out

    return run


# --------------------------------------------------------------- outliers
@dataclass
class Fit:
    """The axes of one problem after some rounds of removal."""

    active: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    sites: float
    trace: float


def outlying(vectors: np.ndarray, axes: int, sigma: float) -> np.ndarray:
    """Rows further than ``sigma`` standard deviations from the mean of any of the
    first ``axes`` columns."""
    lead = vectors[:, :axes]
    return (np.abs(lead - lead.mean(axis=0)) > sigma * lead.std(axis=0)).any(axis=1)


def removal_chain(
    chunks: DataFrame, strains: list[str], keys: list[int], rounds: int, k: int, axes: int, sigma: float
) -> tuple[dict[int, list[Fit]], dict[int, dict[str, int]]]:
    """For each problem its fits after 0, 1, .. removals, ``rounds`` at most, and
    which strains were removed in which round.  A run with fewer rounds is the
    beginning of this one, so one chain serves every number of rounds; all
    problems take their rounds together."""
    fits: dict[int, list[Fit]] = {key: [] for key in keys}
    removed: dict[int, dict[str, int]] = {key: {} for key in keys}
    active = {key: np.arange(len(strains)) for key in keys}
    open_ = [key for key in keys if strains]
    while open_:
        totals: dict[int, tuple[float, float]] = {}
        product = chunk_product(chunks, len(strains), active, totals)
        found = leading({key: Problem(len(active[key]), max(k, axes)) for key in open_}, product)
        still = []
        for key in open_:
            values, vectors = found[key]
            fits[key].append(Fit(active[key], values[:k], vectors[:, :k], *totals[key]))
            away = outlying(vectors, axes, sigma)
            if len(fits[key]) <= rounds and away.any() and not away.all():
                for at in active[key][away]:
                    removed[key][strains[at]] = len(fits[key])
                active[key] = active[key][~away]
                still.append(key)
        open_ = still
    return fits, removed
