"""Leading eigenpairs without the matrix, and the outlier axis of the sweep."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoframe.operators import eigen as E
from genoframe.operators import pca as P
from genoframe.plans import pca_q
from genoframe.session import ship_package
from genoframe.sources.fixtures import fixture


def geno(spark, dosages):
    rows = [
        (i, "I", 10 * i + 1, "A", "C", f"s{s:03d}", "./." if g < 0 else ("0/0", "0/1", "1/1")[g])
        for i, site in enumerate(dosages)
        for s, g in enumerate(site)
    ]
    return spark.createDataFrame(rows, "site_id long, chrom string, pos long, ref string, alt string, strain string, gt string")


def plain_grm(dosages):
    z = E._normalised(np.asarray(dosages, float))
    return z.T @ z / len(z)


def structured(rng, sites, samples, groups=12):
    """Dosages of samples that fall in groups, so that axes stand out of the noise."""
    share = rng.beta(0.4, 0.6, (sites, groups))
    return rng.binomial(2, share[:, np.arange(samples) % groups])


def test_wide_matrix_needs_few_rounds(spark):
    """200 samples, 10 axes: the basis stays far below the order of the matrix,
    and the products come from Spark."""
    ship_package(spark)
    dosages = structured(np.random.RandomState(1), 700, 200)
    dosages[::50, 3] = -1
    chunks, strains = E.site_chunks(geno(spark, dosages), chunk=128)
    totals, calls = {}, []
    product = E.chunk_product(chunks, 200, {0: np.arange(200)}, totals)

    def counted(blocks):
        calls.append({key: q.shape[1] for key, q in blocks.items()})
        return product(blocks)

    values, vectors = E.leading({0: E.Problem(200, 10)}, counted)[0]
    a = plain_grm(dosages)
    want = np.linalg.eigvalsh(a)[::-1][:10]
    assert strains == sorted(strains) and totals[0] == (700, pytest.approx(np.trace(a)))
    assert np.allclose(values, want, rtol=1e-9)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-6
    assert np.allclose(vectors.T @ vectors, np.eye(10), atol=1e-9)
    assert max(c[0] for c in calls) <= 18 and len(calls) < 25


def test_solver_on_awkward_matrices():
    rng = np.random.RandomState(2)
    q = np.linalg.qr(rng.randn(60, 60))[0]
    for spectrum in (np.ones(60), np.r_[np.full(5, 7.0), np.zeros(55)], np.zeros(60), np.linspace(1, 2, 60), np.r_[1e6, rng.rand(59)]):
        a = q @ np.diag(spectrum) @ q.T
        values, vectors = E.leading({0: E.Problem(60, 6)}, lambda b: {k: a @ x for k, x in b.items()}, wide=2)[0]
        assert np.allclose(values, np.sort(spectrum)[::-1][:6], atol=1e-7 * max(1, spectrum.max()))
        assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-8)
    for n in (1, 2, 5):
        a = np.diag(np.arange(1.0, n + 1))
        assert E.leading({0: E.Problem(n, 10)}, lambda b: {k: a @ x for k, x in b.items()})[0][0].tolist() == pytest.approx(list(range(n, 0, -1)))


def test_no_task_holds_the_matrix(spark, sf_dir):
    sites = P.pca_sites(fixture(spark, sf_dir, "f_geno"))
    chunks, strains = E.site_chunks(sites, chunk=20)
    sizes = [len(r.tags) for r in chunks.collect()]
    assert sum(sizes) == sites.select("site_id").distinct().count() and len(sizes) > 3 and max(sizes) < 50
    import inspect

    source = inspect.getsource(P) + inspect.getsource(E)
    assert "_all" not in source and 'groupBy("ld").applyInPandas' not in source


def separate(geno_df, ld, iterations, sigma):
    """One setting on its own: dense algebra on the collected sites."""
    g = P.pca_input(geno_df, ld).select("site_id", "strain", F.expr("cast(substr(gt, 1, 1) as int) + cast(substr(gt, 3, 1) as int)").alias("g"))
    table = g.toPandas().pivot(index="site_id", columns="strain", values="g")
    removed = {}
    for it in range(iterations + 1):
        values, vectors = np.linalg.eigh(plain_grm(table.to_numpy(float)))
        values, vectors = values[::-1], vectors[:, ::-1]
        away = E.outlying(vectors, 2, sigma)
        if it == iterations or not away.any():
            break
        removed |= {s: it + 1 for s in table.columns[away]}
        table = table.loc[:, ~away]
    return list(table.columns), values, vectors, removed


def test_sweep_equals_separate_runs(spark, sf_dir):
    g = pca_q.planted(fixture(spark, sf_dir, "f_geno")).cache()
    pair = {r.strain for r in g.select("strain").distinct().orderBy("strain").limit(2).collect()}
    swept = P.pca_outlier_sweep(g, [0.8, 0.6], [0, 1, 5], k=4, n_evec=2, sigma=3.0).toPandas()
    for ld in (0.8, 0.6):
        for iterations in (0, 1, 5):
            names, values, vectors, removed = separate(g, ld, iterations, 3.0)
            part = swept[(swept.ld == ld) & (swept.outlier_iterations == iterations)]
            gone = part[part.removed_at.notna()]
            assert dict(zip(gone.strain, gone.removed_at)) == removed
            assert (pair <= removed.keys()) == (iterations > 0)
            axes = part[part.pc.notna()]
            for c in range(4):
                one = axes[axes.pc == c + 1].set_index("strain").loc[names]
                assert np.allclose(one.eigenvalue, values[c], rtol=1e-8)
                assert abs(abs(one.loading.to_numpy() @ vectors[:, c]) - 1) < 1e-6
                assert np.allclose(one.var_exp, values[c] / values.sum(), rtol=1e-8)


def test_singletons_are_optional(spark, sf_dir):
    g = fixture(spark, sf_dir, "f_geno")
    kept = {r.site_id for r in P.pca_input(g, 0.8, drop_singletons=False).select("site_id").distinct().collect()}
    without = {r.site_id for r in P.pca_input(g, 0.8).select("site_id").distinct().collect()}
    assert without <= kept


def test_empty_input(spark):
    none = geno(spark, []).limit(0)
    gone, final = P.pca_outlier_removal(none)
    assert gone.count() == 0 and final.count() == 0
    assert P.pca(P.relatedness(none)).count() == 0
