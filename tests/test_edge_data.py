"""Edge data that the fixtures do not hold: phased, half-missing and polyploid
calls, records that share a position, files that list samples in any order,
strains and contigs without reads, more strains than axes."""

from __future__ import annotations

import numpy as np
import pytest

from genoframe.operators import intervals as I
from genoframe.operators import pca as P
from genoframe.operators import variants as V
from genoframe.sources import io
from genoframe.sources.fixtures import fixture

GENO = "site_id long, chrom string, pos long, ref string, alt string, strain string, gt string"


def geno(spark, rows):
    return spark.createDataFrame(rows, GENO)


def test_vcf_files_may_list_samples_in_any_order(spark, tmp_path):
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    body = "\t.\tA\tC\t.\tPASS\t.\tGT:DP\t"
    (tmp_path / "a.vcf").write_text(f"##x\n{head}S1\tS2\nI\t10{body}0/0:3\t1/1:4\n")
    (tmp_path / "b.vcf").write_text(f"##x\n{head}./S2\t./S1\nI\t20{body}1|1:3\t./.:4\n")
    sites, calls = io.read_vcf(spark, str(tmp_path))
    got = {(r.pos, r.strain): r.gt for r in calls.collect()}
    assert got == {(10, "S1"): "0/0", (10, "S2"): "1/1", (20, "S2"): "1|1", (20, "S1"): "./."}
    assert sites.count() == 2 and {r.site_id for r in sites.collect()} == {r.site_id for r in calls.collect()}


def test_vcf_feeds_the_operators(spark, sf_dir, tmp_path):
    from genoframe.operators import alignment as A

    direct = fixture(spark, sf_dir, "f_geno")
    io.write_vcf(direct, str(tmp_path / "vcf"))
    _, read = io.read_vcf(spark, str(tmp_path / "vcf"))
    sheet = direct.filter("strain <> 'S3'").select("strain").distinct()
    flows = [V.polymorphic_sites(V.subset_samples(g, sheet)) for g in (direct, read)]
    counts = [
        {(r.chrom, r.pos, r.alt_allele): (r.ac, r.an, r.ns) for r in V.site_counts(f).collect()} for f in flows
    ]
    assert counts[0] == counts[1] and counts[0]
    seqs = [{r.strain: r.seq for r in A.alignment_by_strain(f).collect()} for f in flows]
    assert seqs[0] == seqs[1] and "S3" not in seqs[0]
    merged = V.complete_sites(V.merge_multiallelic(read))
    assert merged.columns[-1] == "site_id" and merged.count() > 0


def test_merge_of_records_at_one_position(spark):
    rows = [
        (1, "I", 5, "A", "C", "x", "0/0/1"), (1, "I", 5, "A", "C", "y", "./././."),
        (2, "I", 5, "AT", "A,AG", "x", "2/0/0"), (2, "I", 5, "AT", "A,AG", "y", "0/0/2/1"),
        (3, "I", 9, "G", "<DEL>", "x", "0|1"),
    ]
    got = {(r.pos, r.strain): (r.ref, r.alt, r.gt) for r in V.merge_multiallelic(geno(spark, rows)).collect()}
    # A>C becomes AT>CT; sorted ALTs: A, AG, CT
    assert got == {
        (5, "x"): ("AT", "A,AG,CT", "2/0/3"),
        (5, "y"): ("AT", "A,AG,CT", "0/0/2/1"),
        (9, "x"): ("G", "<DEL>", "0/1"),
    }


def test_ancestor_of_phased_and_half_missing_calls(spark):
    rows = [(1, "I", 5, "A", "C", "x", "1|1"), (2, "I", 6, "A", "C", "x", "./1"), (3, "I", 7, "A", "C", "x", "0|1")]
    assert {(r.start, r.allele) for r in V.ancestor_bed(geno(spark, rows)).collect()} == {(4, "C"), (5, "."), (6, "A")}


def test_r2_with_absent_call_rows(spark):
    """A strain without a row at a site must not shift the other strains."""
    a = ["0/0", "1/1", "0/0", "1/1", "1/1", "0/0"]
    rows = [(1, "I", 5, "A", "C", f"s{i}", g) for i, g in enumerate(a)]
    rows += [(2, "I", 6, "A", "C", f"s{i}", g) for i, g in enumerate(a) if i != 1]
    (r,) = V.ld_r2(geno(spark, rows)).collect()
    assert (r.site1, r.site2) == (1, 2) and r.r2 == pytest.approx(1.0)


def test_r2_blocks_cover_every_pair_of_a_window(spark):
    rng = np.random.RandomState(2)
    d = rng.randint(-1, 3, (40, 9))
    gts = {-1: "./.", 0: "0/0", 1: "0/1", 2: "1/1"}
    rows = [(i, "I", 10 * i + 1, "A", "C", f"s{s}", gts[d[i, s]]) for i in range(40) for s in range(9)]
    got = {(r.site1, r.site2): r.r2 for r in V.ld_r2_ranked(V.site_ranks(geno(spark, rows)), window=6, block=7).collect()}
    assert set(got) == {(i, j) for i in range(40) for j in range(i + 1, min(40, i + 6))}
    for (i, j), r2 in got.items():
        ok = (d[i] >= 0) & (d[j] >= 0)
        x, y = d[i][ok], d[j][ok]
        if len(x) and x.std() and y.std():
            assert r2 == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
        else:
            assert r2 is None


def test_every_strain_gets_every_contig(spark):
    lengths = spark.createDataFrame([("I", 2500), ("II", 1000)], "chrom string, chrom_length long")
    reads = spark.createDataFrame([("a", "I", 0, 500)], "strain string, chrom string, start_pos long, end_pos long")
    names = spark.createDataFrame([("a",), ("b",)], "strain string")
    depth = {(r.strain, r.chrom, r.start_bin): r.coverage for r in I.interval_mean_depth(reads, lengths, strains=names).collect()}
    bins = [("I", 0), ("I", 1000), ("I", 2000), ("II", 0)]
    assert depth == {(s, c, b): 0.5 if (s, c, b) == ("a", "I", 0) else 0.0 for s in "ab" for c, b in bins}
    calls = geno(spark, [(1, "I", 5, "A", "C", "a", "1/1"), (1, "I", 5, "A", "C", "b", "0/0")])
    mask = I.mask_from_calls(calls, reads, lengths, strains=names)
    parts = I.assemble_mask(I.interval_count(calls, lengths, strains=names), I.interval_mean_depth(reads, lengths, strains=names))
    rows = lambda df: sorted(map(tuple, df.select("strain", "chrom", "start_bin", "end_bin", "var_count", "coverage").collect()))
    assert rows(mask) == rows(parts) and len(rows(mask)) == 8


def test_annotation_sources_with_several_columns(spark, tmp_path):
    (tmp_path / "a.bed").write_text("I\t0\t10\tx\ty\n")
    config = io.annotation_config(
        f'[[annotation]]\nfile="{tmp_path}/a.bed"\ncolumns=[4,5]\nnames=["one","two"]\nops=["self","self"]\n'
    )
    got = [(name, df.collect()[0][name]) for df, name, _ in io.read_annotations(spark, config)]
    assert got == [("one", "x"), ("two", "y")]


def test_tail_sums_do_not_depend_on_the_axes_kept(spark):
    """60 strains, more than the 50 axes that are kept."""
    rng = np.random.RandomState(5)
    rows = [
        (i, "I", 10 * i + 1, "A", "C", f"s{s:02d}", ("0/0", "0/1", "1/1")[g])
        for i, site in enumerate(rng.randint(0, 3, (150, 60)))
        for s, g in enumerate(site)
    ]
    grm = P.relatedness(geno(spark, rows)).cache()
    totals = P.spectrum_totals(grm)
    tables = {}
    for k in (10, 50, 60):
        eig = P.eigenvalues(P.pca(grm, k))
        tables[k] = (
            {r.n: (r.twstat, r.effect_n, r.p_value) for r in P.tracy_widom(eig, totals).collect()},
            {r.n: r.var_exp for r in P.variance_explained(eig, totals=totals).collect()},
        )
    for n in range(1, 11):
        for k in (10, 50):
            assert tables[k][0][n] == pytest.approx(tables[60][0][n], rel=1e-6)
            assert tables[k][1][n] == pytest.approx(tables[60][1][n], rel=1e-9)
    assert sum(tables[60][1].values()) < 1


def test_tracy_widom_tail(spark):
    # Published quantiles of the law: 0.95 at 0.9793, 0.99 at 2.0234
    assert P._gamma_upper(46.446, (0.9793 + 9.84801) / 0.186054) == pytest.approx(0.05, abs=2e-3)
    assert P._gamma_upper(46.446, (2.0234 + 9.84801) / 0.186054) == pytest.approx(0.01, abs=1e-3)


def test_a_planted_outlier_is_removed(spark):
    rng = np.random.RandomState(8)
    rows = []
    for i in range(120):
        for s in range(30):
            g = s == 7 if i % 2 else rng.rand() < 0.3
            rows.append((i, "I", 10 * i + 1, "A", "C", f"s{s:02d}", "1/1" if g else "0/0"))
    gone, final = P.pca_outlier_removal(geno(spark, rows), iterations=2, n_evec=1, sigma=4.0)
    assert [(r.strain, r.iteration) for r in gone.collect()] == [("s07", 1)]
    assert final.filter("strain = 's07'").count() == 0


def test_iupac_pairs(spark):
    from genoframe.operators import alignment as A

    rows = [(1, "I", 5, "A", "G", "w", "0/1"), (1, "I", 5, "A", "G", "x", "1|1"), (1, "I", 5, "A", "G", "y", "./."),
            (2, "I", 6, "C", "T", "w", "0/1"), (2, "I", 6, "C", "T", "x", "0/0"), (2, "I", 6, "C", "T", "y", "1/0"),
            (3, "I", 7, "G", "T", "w", "0/1"), (3, "I", 7, "G", "T", "x", "1/1"), (3, "I", 7, "G", "T", "y", "0/0")]
    got = {r.strain: r.seq for r in A.alignment_by_strain(geno(spark, rows), min_samples=1).collect()}
    assert got == {"w": "RYK", "x": "GCT", "y": "NYG"}


def test_ibd_over_filtered_markers(spark, sf_dir):
    from genoframe.operators import ibd as IBD

    calls = fixture(spark, sf_dir, "f_geno")
    kept = IBD.ibd_marker_ld_filter(calls).select("site_id")
    alone = IBD.ibd_segments(calls.join(kept, "site_id", "left_semi"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(IBD.ibd_segments(calls, r2max=IBD.R2_MAX)) == rows(alone)


def test_any_snp_alt_keeps_mixed_sites(spark):
    from genoframe.operators import variants

    sites = [(1, "A", "C"), (2, "A", "C,GT"), (3, "A", "GT,TT"), (4, "AC", "C,T"), (5, "A", "C,T")]
    df = spark.createDataFrame(sites, "site_id int, ref string, alt string")
    kept = lambda mode: {r.site_id for r in variants.filter_snps(df, mode).collect()}
    assert kept("all") == {1, 5} and kept("any") == {1, 2, 5}
