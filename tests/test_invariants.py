"""Invariants for operators without an SQL oracle, edge cases pinned with
literal rows, and plan-shape checks."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genoframe.operators import alignment as A
from genoframe.operators import divergent as D
from genoframe.operators import ibd as IBD
from genoframe.operators import intervals as I
from genoframe.operators import haplotypes as H
from genoframe.operators import pca as P
from genoframe.operators import variants as V
from genoframe.plans.divergent_q import _base_ctes
from genoframe.session import materialize
from genoframe.sources import io
from genoframe.sources.fixtures import fixture, with_fixtures

from helpers import duck_rows, rowset, spark_rows


def _snp(spark, sf_dir):
    return V.biallelic_sites(V.filter_snps(fixture(spark, sf_dir, "f_geno")))


# ----------------------------------------------------------------- B21 / G9
def test_ld_prune_leaves_no_linked_pair_in_a_window(spark, sf_dir):
    g = _snp(spark, sf_dir)
    t = 0.8
    kept = {r.site_id for r in V.ld_prune(g, t).collect()}
    ranks = {r.site_id: r.rank for r in V.site_ranks(g).select("site_id", "rank").collect()}
    assert kept
    for r in V.ld_r2(g).filter(F.col("r2") > t).collect():
        if r.site1 in kept and r.site2 in kept:
            i, j = sorted((ranks[r.site1], ranks[r.site2]))
            shares_window = any(w <= i and j < w + V.LD_WINDOW for w in range(1, i + 1, V.LD_STEP))
            assert not shares_window, (r.site1, r.site2, r.r2)


def test_sweep_counts_equal_single_threshold_runs(spark, sf_dir):
    g = fixture(spark, sf_dir, "f_geno")
    sweep = {r.ld: r.kept_sites for r in P.parameter_sweep(g, [0.8, 0.6], [5]).collect()}
    snp = V.biallelic_sites(V.filter_snps(V.filter_regions(g)))
    for t in (0.8, 0.6):
        assert sweep[t] == V.ld_prune(snp, t).count()


# ----------------------------------------------------------------- E2
def test_ibd_chunked_equals_single_chunk(spark, sf_dir):
    g = fixture(spark, sf_dir, "f_geno")
    whole = {tuple(r) for r in IBD.ibd_segments(g).collect()}
    pieces = {tuple(r) for r in IBD.ibd_segments(g, chunk=8, pair_block=5).collect()}
    assert whole and whole == pieces


def test_ibd_segments_are_well_formed(spark, sf_dir):
    seg = IBD.ibd_segments(fixture(spark, sf_dir, "f_geno"))
    bad = seg.filter((F.col("strain1") >= F.col("strain2")) | (F.col("start_pos") > F.col("stop_pos")) | (F.col("lod") < 3))
    assert bad.count() == 0


# ----------------------------------------------------------------- F4
def test_resolve_heterozygous_picks_an_allele_of_the_call(spark, sf_dir):
    df = A.resolve_heterozygous(fixture(spark, sf_dir, "f_geno"))
    rows = df.collect()
    for r in rows:
        alleles = r.gt.replace("|", "/").split("/") if not r.gt.startswith(".") else [".", "."]
        picked = r.gt_resolved.replace("|", "/").split("/")
        assert len(set(picked)) == 1 and picked[0] in alleles
    again = {(r.site_id, r.strain, r.gt_resolved) for r in A.resolve_heterozygous(fixture(spark, sf_dir, "f_geno")).collect()}
    assert again == {(r.site_id, r.strain, r.gt_resolved) for r in rows}


# ----------------------------------------------------------------- G3 / G4 / G5
def test_pca_eigenpairs(spark, sf_dir):
    sites = P.pca_sites(fixture(spark, sf_dir, "f_geno"))
    grm = P.relatedness(sites).toPandas()
    names = sorted(set(grm.strain1) | set(grm.strain2))
    pos = {s: i for i, s in enumerate(names)}
    a = np.zeros((len(names), len(names)))
    for s1, s2, v in zip(grm.strain1, grm.strain2, grm.grm):
        a[pos[s1], pos[s2]] = a[pos[s2], pos[s1]] = v
    pcs = P.pca(P.relatedness(sites), k=5).toPandas()
    vecs = []
    for k in range(1, 6):
        part = pcs[pcs.pc == k].set_index("strain").loc[names]
        v = part.loading.to_numpy()
        lam = part.eigenvalue.iloc[0]
        assert np.linalg.norm(a @ v - lam * v) < 1e-8
        vecs.append(v)
    gram = np.array(vecs) @ np.array(vecs).T
    assert np.allclose(gram, np.eye(5), atol=1e-10)
    assert np.trace(a) >= sum(pcs.groupby("pc").eigenvalue.first()) - 1e-9


def test_outlier_removal_runs(spark, sf_dir):
    sites = P.pca_sites(fixture(spark, sf_dir, "f_geno"))
    removed, final = P.pca_outlier_removal(sites, iterations=2)
    all_strains = {r.strain for r in sites.select("strain").distinct().collect()}
    gone = {r.strain for r in removed.collect()}
    kept = {r.strain for r in final.select("strain").distinct().collect()}
    assert gone | kept == all_strains and not (gone & kept)


# ----------------------------------------------------------------- G6 / G7 / G8 on the fixed tables
def _tw_reference(vals: np.ndarray) -> list[tuple]:
    out = []
    for k in range(len(vals)):
        rest = vals[k:]
        m = len(rest) + 1
        s1, s2 = rest.sum(), (rest**2).sum()
        den = (m - 1) * s2 - s1**2
        if den == 0:
            out.append((k + 1, None, None))
            continue
        neff = (m + 1) * s1**2 / den
        ell = (m - 1) * rest[0] / s1
        a = np.sqrt(neff - 1) + np.sqrt(m)
        mu = a * a / neff
        sig = a / neff * (1 / np.sqrt(neff - 1) + 1 / np.sqrt(m)) ** (1 / 3)
        out.append((k + 1, (ell - mu) / sig, neff))
    return out


def test_tracy_widom_formula(spark, sf_dir):
    eig = fixture(spark, sf_dir, "f_eigen").select(F.col("n").cast("bigint").alias("n"), "eigenvalue")
    got = {r.n: r for r in P.tracy_widom(eig).collect()}
    vals = np.array([r.eigenvalue for r in eig.orderBy("n").collect()])
    for n, tw, neff in _tw_reference(vals):
        if neff is None or neff <= 1:
            continue
        assert abs(got[n].twstat - tw) < 1e-9 and abs(got[n].effect_n - neff) < 1e-9
    assert got[1].difference is None and abs(got[2].difference - (vals[1] - vals[0])) < 1e-12


def test_variance_explained_and_pc_pairs(spark, sf_dir, duck):
    eig = fixture(spark, sf_dir, "f_eigen").select(F.col("n").cast("bigint").alias("n"), "eigenvalue")
    ve = P.variance_explained(eig)
    sql = with_fixtures(
        ["f_eigen"],
        "SELECT n, 'PC' || CAST(n AS VARCHAR) AS label, eigenvalue / SUM(eigenvalue) OVER () AS var_exp, "
        "SUM(eigenvalue) OVER (ORDER BY n) / SUM(eigenvalue) OVER () AS cum_var_exp FROM f_eigen QUALIFY n <= 10",
    )
    assert rowset(*spark_rows(ve)) == rowset(*duck_rows(duck, sql))
    pairs = P.pc_pairs(fixture(spark, sf_dir, "f_pc"), ve).collect()
    assert len(pairs) == 25 * 15
    r = next(p for p in pairs if p.strain == "S3" and p.x_pc == "PC2" and p.y_pc == "PC5")
    pc = {x.strain: x for x in fixture(spark, sf_dir, "f_pc").collect()}["S3"]
    assert (r.x, r.y) == (pc.pc2, pc.pc5)
    assert r.x_label.startswith("PC2 (") and r.x_label.endswith("%)")


# ----------------------------------------------------------------- D edge cases with literal rows
def _mask_rows():
    rows = []
    div = set(range(0, 10)) | set(range(13, 25)) | (set(range(30, 40)) - {35})
    for b in range(40):
        rows.append(("A", "I", b * 1000, b * 1000 + 1000, 20 if b in div else 5, 20.0))
        rows.append(("B", "I", b * 1000, b * 1000 + 1000, 5, 20.0))
    return rows


def test_divergent_edge_cases(spark, duck):
    pdf = pd.DataFrame(_mask_rows(), columns=["strain", "chrom", "start_bin", "end_bin", "var_count", "coverage"])
    mask = spark.createDataFrame(pdf)
    got = {tuple(r) for r in D.divergent_regions(mask).collect()}
    # cluster at bin 0; a 3-bin gap joined and filled; a 5-bin gap fills 4
    # bins and stays split; a TwoFlank bin inside the last cluster; the last
    # cluster ends at the chromosome end.
    assert got == {("A", "I", 0, 29000, 29000), ("A", "I", 30000, 10000, 40000)}
    duck.register("f_mask_lit", pdf)
    sql = with_fixtures([], "SELECT * FROM reg", _base_ctes()).replace("FROM f_mask", "FROM f_mask_lit")
    assert rowset(*spark_rows(D.divergent_regions(mask))) == rowset(*duck_rows(duck, sql))


# ----------------------------------------------------------------- B / F edge cases
def test_site_counts_half_missing_and_all_missing(spark):
    rows = [
        (1, "I", 10, "A", "C", "S1", "0/."),
        (1, "I", 10, "A", "C", "S2", "1/1"),
        (2, "I", 20, "G", "T", "S1", "./."),
        (2, "I", 20, "G", "T", "S2", "./."),
    ]
    g = spark.createDataFrame(rows, "site_id long, chrom string, pos long, ref string, alt string, strain string, gt string")
    c = {r.site_id: r for r in V.site_counts(g).collect()}
    assert (c[1].ac, c[1].an, c[1].ns) == (2, 3, 2)
    assert (c[2].ac, c[2].an, c[2].ns, c[2].af) == (0, 0, 0, None)
    assert {r.site_id for r in V.polymorphic_sites(g).collect()} == {1}


def test_iupac_with_deletion_allele(spark):
    rows = [
        (1, "I", 10, "A", "*", "S1", "0/1"),
        (1, "I", 10, "A", "*", "S2", "1/1"),
        (1, "I", 10, "A", "*", "S3", "0/0"),
        (1, "I", 10, "A", "*", "S4", "./."),
        (1, "I", 10, "A", "*", "S5", "0/0"),
    ]
    g = spark.createDataFrame(rows, "site_id long, chrom string, pos long, ref string, alt string, strain string, gt string")
    got = {r.strain: r.base for r in A.iupac_calls(g).collect()}
    assert got == {"S1": "a", "S2": "-", "S3": "A", "S4": "N", "S5": "A"}
    # four called samples are required (min(4, n)): drop one and the site is too shallow
    assert A.iupac_calls(g.filter(F.col("strain") != "S5")).count() == 0


# ----------------------------------------------------------------- plan shapes
def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "build",
    [
        lambda s, d, g, seg: I.interval_count(g, materialize(fixture(s, d, "f_chrom"))),
        lambda s, d, g, seg: I.interval_mean_depth(materialize(fixture(s, d, "f_align")), materialize(fixture(s, d, "f_chrom"))),
        lambda s, d, g, seg: V.interval_annotate(materialize(fixture(s, d, "f_site")), materialize(fixture(s, d, "f_annot")), "cm"),
        lambda s, d, g, seg: I.interval_overlap_join(seg, materialize(fixture(s, d, "f_annot"))),
        lambda s, d, g, seg: H.segment_interval_join(seg),
        lambda s, d, g, seg: V.ld_r2(g),
    ],
)
def test_no_nested_loop_or_cartesian(spark, sf_dir, build):
    g = materialize(fixture(spark, sf_dir, "f_geno"))
    seg = materialize(fixture(spark, sf_dir, "f_seg"))
    plan = _physical(build(spark, sf_dir, g, seg))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_divergent_plan_shuffles_once_on_strain_chrom(spark, sf_dir):
    mask = materialize(fixture(spark, sf_dir, "f_mask"))
    plan = _physical(D.divergent_regions(mask))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


# ----------------------------------------------------------------- A6 file names, streaming
def _write_mask_files(tmp_path, spark, sf_dir, strains):
    m = fixture(spark, sf_dir, "f_mask").filter(F.col("strain").isin(strains)).toPandas()
    for s, part in m.groupby("strain"):
        out = part[["chrom", "start_bin", "end_bin", "var_count", "coverage"]]
        out.columns = ["CHROM", "START_BIN", "END_BIN", "VAR_COUNT", "COVERAGE"]
        out.to_csv(tmp_path / f"{s}_Mask_DF.tsv", sep="\t", index=False)
    return m


def test_mask_scan_takes_strain_from_file_name(spark, sf_dir, tmp_path):
    m = _write_mask_files(tmp_path, spark, sf_dir, ["S1", "S7"])
    got = io.read_masks(spark, str(tmp_path))
    assert {r.strain for r in got.select("strain").distinct().collect()} == {"S1", "S7"}
    assert got.count() == len(m)


def test_stream_regions_equal_batch(spark, sf_dir, tmp_path):
    from genoframe.streaming.masks import start_region_stream

    src = tmp_path / "in"
    src.mkdir()
    strains = ["S0", "S5", "S10"]
    _write_mask_files(src, spark, sf_dir, strains)
    # a named stream resumes from its checkpoint: give each test run its own name
    q = start_region_stream(spark, str(src), str(tmp_path / "regions"), str(tmp_path / "masks"), name=f"t-{uuid.uuid4().hex}")
    q.awaitTermination(120)
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "regions")).select(
        "strain", "chrom", "cluster_start", "cluster_size", "cluster_end").collect()}
    batch_mask = fixture(spark, sf_dir, "f_mask").filter(F.col("strain").isin(strains))
    batch = {tuple(r) for r in D.divergent_regions(batch_mask).collect()}
    assert streamed == batch and batch


# ----------------------------------------------------------------- E1 LD filter vs brute force
def test_ibd_marker_ld_filter_matches_forward_greedy(spark, sf_dir):
    g = fixture(spark, sf_dir, "f_geno")
    got = {r.site_id for r in IBD.ibd_marker_ld_filter(g).collect()}
    markers = {r.site_id for r in IBD.ibd_markers(g).collect()}
    arr = V.site_dosage_arrays(g.filter(F.col("site_id").isin(list(markers)))).toPandas()
    expected = set()
    for _, part in arr.sort_values(["chrom", "pos", "site_id"]).groupby("chrom"):
        ids = part.site_id.tolist()
        dos = [np.array([np.nan if x is None else x for x in d], dtype=float) for d in part.dos]
        kept: list[int] = []
        for j in range(len(ids)):
            linked = False
            for i in kept:
                if j - i >= IBD.R2_WINDOW:
                    continue
                ok = ~np.isnan(dos[i]) & ~np.isnan(dos[j])
                x, y = dos[i][ok], dos[j][ok]
                n = len(x)
                vx, vy = n * (x * x).sum() - x.sum() ** 2, n * (y * y).sum() - y.sum() ** 2
                if vx > 0 and vy > 0:
                    cv = n * (x * y).sum() - x.sum() * y.sum()
                    if cv * cv / (vx * vy) > IBD.R2_MAX:
                        linked = True
                        break
            if not linked:
                kept.append(j)
        expected |= {ids[k] for k in kept}
    assert got == expected and got


def test_pca_sweep_matches_single_setting(spark, sf_dir):
    g = fixture(spark, sf_dir, "f_geno")
    sweep = P.pca_sweep(g, [0.8, 0.6], k=3).toPandas()
    for t in (0.8, 0.6):
        ev = P.eigenvalues(P.pca(P.relatedness(P.pca_input(g, t)), k=3)).toPandas().sort_values("n")
        got = sweep[sweep.ld == t].sort_values("pc")
        assert np.allclose(got.eigenvalue.to_numpy(), ev.eigenvalue.to_numpy(), rtol=1e-9, atol=1e-9)
