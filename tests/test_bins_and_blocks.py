"""Nested bins, run-length bin grids and block-wise pruning against brute force."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from genoframe.functions import bins as B
from genoframe.operators import divergent as D
from genoframe.operators import intervals as I
from genoframe.operators import pruning
from genoframe.operators import variants as V
from genoframe.session import materialize, stored

CONTIG = 20_000_000


def spans(rnd, n):
    """Short, long and contig-long spans, some on bin borders, and repeats."""
    out = []
    for _ in range(n):
        size = rnd.choice([1, 2, 30, 1024, 1025, 8192, 70_000, 900_000, CONTIG])
        start = rnd.choice([0, 1023, 1024, 8191, 65_536, rnd.randrange(CONTIG)])
        out.append((rnd.choice(["I", "II", None]), start, start + size))
    return out + out[:3]


def test_overlap_join_equals_brute_force(spark):
    rnd = random.Random(5)
    left, right = spans(rnd, 150), spans(rnd, 60)
    a = spark.createDataFrame([(i, *s) for i, s in enumerate(left)], "i int, c string, s long, e long")
    b = spark.createDataFrame([(i, *s) for i, s in enumerate(right)], "j int, rc string, rs long, re long")
    got = B.overlap_join(a, b, ("c", F.col("s"), F.col("e")), ("rc", F.col("rs"), F.col("re")))
    rows = sorted((r.i, r.j) for r in got.collect())
    want = sorted(
        (i, j)
        for i, (c, s, e) in enumerate(left)
        for j, (rc, rs, re) in enumerate(right)
        if c is not None and c == rc and s < re and rs < e
    )
    assert rows == want and want
    assert got.columns == ["i", "c", "s", "e", "j", "rc", "rs", "re"]
    none = B.overlap_join(a, b.limit(0), ("c", F.col("s"), F.col("e")), ("rc", F.col("rs"), F.col("re")))
    assert none.count() == 0


def test_rows_per_interval_are_bounded_by_the_levels(spark):
    df = spark.createDataFrame([(s, e) for _, s, e in spans(random.Random(6), 200)], "s long, e long")
    s, e = F.col("s"), F.col("e")
    levels = F.sequence(B.own_level(s, e), F.lit(B.LEVELS - 1))
    assert df.select(F.max(F.size(B.bins_at(s, e, levels, 0)))).first()[0] <= 2 * B.LEVELS


def test_closed_overlap_join_keeps_touching_ends(spark):
    a = spark.createDataFrame([("I", 10, 1024, "x"), ("I", 1, CONTIG, "y")], "chrom string, start_pos long, stop_pos long, tag string")
    b = spark.createDataFrame([("I", 1024, 2000), ("I", 1025, 2000), ("II", 10, 20)], "chrom string, start_pos long, end_pos long")
    got = sorted((r.tag, r.r_start_pos) for r in I.interval_overlap_join(a, b).collect())
    assert got == [("x", 1024), ("y", 1024), ("y", 1025)]


def test_bin_grids_of_contig_long_intervals(spark):
    rnd = random.Random(7)
    length = 100_500
    lengths = spark.createDataFrame([("I", length), ("II", 2_000)], "chrom string, chrom_length long")
    reads = [("w", "I", 0, length), ("w", "I", 999, 1001), ("w", "I", 1000, 3000)]
    reads += [("x", "I", s, min(s + rnd.choice([1, 150, 1000, 2000, 7001]), length)) for s in (rnd.randrange(length) for _ in range(80))]
    aligned = spark.createDataFrame(reads, "strain string, chrom string, start_pos long, end_pos long")
    got = {(r.strain, r.chrom, r.start_bin): (r.end_bin, r.coverage) for r in I.interval_mean_depth(aligned, lengths).collect()}
    assert len(got) == 2 * (101 + 2)
    for (strain, chrom, start), (end, coverage) in got.items():
        bases = sum(max(0, min(e, end) - max(s, start)) for n, c, s, e in reads if (n, c) == (strain, chrom))
        assert coverage == int(bases * 100 / (end - start) + 0.5) / 100

    calls = [("w", "I", 1, "A" * 50_000, "1/1"), ("w", "I", 1000, "AC", "0/1"), ("w", "I", 1001, "A", "0/1"),
             ("w", "I", 100_500, "A", "1/1"), ("w", "II", 5, "A", "0/0"), ("x", "II", 2000, "ACG", "./1")]
    geno = spark.createDataFrame(calls, "strain string, chrom string, pos long, ref string, gt string")
    got = {(r.strain, r.chrom, r.start_bin): (r.end_bin, r.var_count) for r in I.interval_count(geno, lengths).collect()}
    assert len(got) == 2 * (101 + 2)
    for (strain, chrom, start), (end, n) in got.items():
        hits = [1 for s, c, p, ref, gt in calls if (s, c) == (strain, chrom) and "1" in gt and p - 1 < end and p - 1 + len(ref) > start]
        assert n == len(hits)
    sparse = I._depth_sparse(aligned, 1000)
    assert sparse.count() <= 3 * len(reads)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_gap_fill_blocks_change_no_bin(spark, monkeypatch, block):
    """Reads that begin before the contig, cross many blocks or pass its end."""
    rnd = random.Random(block)
    lengths = spark.createDataFrame([("I", 41_000), ("II", 900), ("III", None)], "chrom string, chrom_length long")
    spans = [(-2500, 900), (-500, 41_000), (0, 41_000), (6999, 7001), (7000, 14_000), (39_900, 90_000), (45_000, 46_000)]
    spans += [(s, s + rnd.choice([1, 150, 1000, 3000, 20_001])) for s in (rnd.randrange(40_000) for _ in range(40))]
    reads = [(rnd.choice("wx"), "I", s, e) for s, e in spans] + [("y", "III", 5, 5000), ("y", "IV", 5, 5000), ("w", "I", None, 7)]
    aligned = spark.createDataFrame(reads, "strain string, chrom string, start_pos long, end_pos long")
    calls = [(n, c, s + 1, "A" * (e - s), "1/1") for n, c, s, e in reads if s is not None]
    geno = spark.createDataFrame(calls, "strain string, chrom string, pos long, ref string, gt string")
    names = spark.createDataFrame([("w",), ("z",)], "strain string")
    monkeypatch.setattr(I, "BLOCK_BINS", block)
    depth = {(r.strain, r.chrom, r.start_bin, r.end_bin): r.coverage for r in I.interval_mean_depth(aligned, lengths).collect()}
    count = {(r.strain, r.chrom, r.start_bin, r.end_bin): r.var_count for r in I.interval_count(geno, lengths).collect()}
    grid = {(n, "I", b, min(b + 1000, 41_000)) for n in "wxy" for b in range(0, 41_000, 1000)} | {(n, "II", 0, 900) for n in "wxy"}
    assert set(depth) == set(count) == grid
    for (strain, chrom, start, end), coverage in depth.items():
        over = [min(e, end) - max(s, start) for n, c, s, e in reads if (n, c) == (strain, chrom) and s is not None and s < end and e > start]
        assert coverage == int(sum(over) * 100 / (end - start) + 0.5) / 100
        assert count[strain, chrom, start, end] == len(over)
    named = {(r.strain, r.chrom) for r in I.interval_mean_depth(aligned, lengths, strains=names).collect()}
    assert named == {("w", "I"), ("w", "II"), ("z", "I"), ("z", "II"), ("x", "I")}


def test_gap_fill_of_a_contig_longer_than_an_array(spark):
    """3,000,000,000 bins after the only read: no task lists them at once."""
    lengths = spark.createDataFrame([("I", 3 * 10**12)], "chrom string, chrom_length long")
    aligned = spark.createDataFrame([("w", "I", 0, 500)], "strain string, chrom string, start_pos long, end_pos long")
    assert len(I.interval_mean_depth(aligned, lengths).limit(3).collect()) == 3


MASK = "strain string, chrom string, start_bin long, end_bin long, var_count long, coverage double"


def regions_by_bin(mask, threshold):
    """D1-D10 with a row for every bin."""
    joined = D.gap_joined_clusters(mask).filter(F.col("cluster_size") >= threshold)
    flagged = D._with_final_flags(joined, threshold)
    first = F.col("is_final") & (F.col("start_bin") == F.col("cluster_start"))
    return flagged.filter(first).select("strain", "chrom", "cluster_start", "cluster_size", "cluster_end")


@pytest.mark.parametrize(("block", "missing", "twice", "threshold"), [(7, 0, 0, 9000), (1, 0.05, 0, 3000), (4, 0.1, 0.1, 9000)])
def test_regions_by_run_lengths_equal_those_by_bins(spark, monkeypatch, block, missing, twice, threshold):
    rnd = random.Random(block)
    rows = []
    for strain, chrom in itertools.product("abcdefghij", ["I", "II", "X", "unplaced", None]):
        divergent, stay = False, rnd.choice([0.5, 0.8, 0.95])
        for b in range(rnd.choice([1, 3, 40, 300])):
            divergent = divergent if rnd.random() < stay else not divergent
            flip = rnd.random() < 0.03
            bin_ = (strain, chrom, b * 1000, b * 1000 + 1000, rnd.choice([20, 3, 3, None]) if divergent else 3, 1.0 if divergent != flip else 30.0)
            if rnd.random() >= missing:
                rows += [bin_, bin_] if rnd.random() < twice else [bin_]
    mask = materialize(spark.createDataFrame(rows, MASK))
    monkeypatch.setattr(D, "BLOCK_BINS", block)
    got = D.divergent_regions(mask, threshold)
    want = regions_by_bin(mask, threshold)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20


def test_a_cluster_as_long_as_its_contig_is_few_rows(spark, monkeypatch):
    """All windows over a contig read the stored runs: two or three a block, not a row per bin."""
    n, block = 20_000, 1000
    low, seen = F.col("id") >= 100, {}
    mask = spark.range(n).select(
        F.lit("w").alias("strain"), F.lit("I").alias("chrom"), (F.col("id") * 1000).alias("start_bin"), (F.col("id") * 1000 + 1000).alias("end_bin"),
        F.when(F.col("id") == n // 2, 20).otherwise(0).cast("long").alias("var_count"), F.when(low, 0.0).otherwise(30.0).alias("coverage"),
    )

    def counted(df, tag, *a):
        out = stored(df, tag, *a)
        seen[tag] = out.count()
        return out

    monkeypatch.setattr(D, "stored", counted)
    monkeypatch.setattr(D, "BLOCK_BINS", block, raising=False)
    got = [tuple(r) for r in D.divergent_regions(mask).collect()]
    assert got == [("w", "I", 100_000, (n - 100) * 1000, n * 1000)]
    assert seen["divergent-runs"] <= 3 * n // block


def brute_removals(edges, window, step):
    gone = set()
    for start in range(1, max(b for _, b, _ in edges) + 1, step):
        for a, b, victim in sorted(edges):
            if start <= a and b < start + window and a not in gone and b not in gone:
                gone.add(victim)
    return gone


@pytest.mark.parametrize(("window", "step", "reach"), [(20, 5, 20), (20, 1, 20), (7, 3, 9), (10, 10, 10)])
def test_blocks_prune_like_one_pass(spark, window, step, reach):
    """One island over 400 ranks: chains of links cross every block border."""
    rnd = random.Random(window * step)
    edges = {(a, a + d) for a in range(1, 400) for d in [1, *rnd.sample(range(1, reach), 2)]}
    edges = [(a, b, rnd.choice([a, b])) for a, b in sorted(edges)]
    df = spark.createDataFrame([(0.5, "I", *e) for e in edges], "ld double, chrom string, a long, b long, victim long")
    want = brute_removals(edges, window, step)
    for block in (None, window):
        got = {r["rank"] for r in pruning.greedy_removals(df, window, step, block).collect()}
        assert got == want and got


def test_a_chain_settles_through_many_blocks(spark):
    """Every other rank goes: what a block removes depends on all blocks before."""
    df = spark.range(1, 60).selectExpr("0.5D ld", "'I' chrom", "id a", "id + 1 b", "id + 1 victim")
    got = sorted(r["rank"] for r in pruning.greedy_removals(df, 5, 1, 5).collect())
    assert got == list(range(2, 61, 2))
    assert pruning.greedy_removals(df.limit(0), 5, 1).count() == 0


def test_ld_prune_does_not_depend_on_the_block(spark, sf_dir):
    from genoframe.sources.fixtures import fixture

    g = V.biallelic_sites(V.filter_snps(fixture(spark, sf_dir, "f_geno")))
    kept = lambda block: {tuple(r) for r in V.ld_prune_sweep(g, [0.8, 0.3], block=block).collect()}
    assert kept(None) == kept(V.LD_WINDOW)


@pytest.mark.parametrize("window", [5, 40])
def test_forward_filter_in_blocks(spark, window):
    """Kept sites only are compared; every block needs the end of the one before."""
    import numpy as np

    rnd = random.Random(window)
    dos = [[rnd.choice([-1, 0, 0, 1, 2, 2]) for _ in range(7)] for _ in range(230)]

    def r2(a, b):
        xy = np.array([(x, y) for x, y in zip(a, b) if x >= 0 and y >= 0], dtype=float).reshape(-1, 2)
        n, (x, y) = len(xy), xy.T
        vx, vy = n * (x * x).sum() - x.sum() ** 2, n * (y * y).sum() - y.sum() ** 2
        return (n * (x * y).sum() - x.sum() * y.sum()) ** 2 / (vx * vy) if vx > 0 and vy > 0 else 0.0

    want = []
    for i, d in enumerate(dos):
        if not any(i - j < window and r2(dos[j], d) > 0.3 for j in want):
            want.append(i)
    assert 10 < len(want) < 200
    df = spark.createDataFrame([("I", i + 1, d) for i, d in enumerate(dos)], "chrom string, rank long, dos array<int>")
    for span in (None, window):
        got = sorted(r["rank"] - 1 for r in pruning.forward_kept(df, window, 0.3, span).collect())
        assert got == want


def test_linked_markers_leave_no_pair_table(spark, monkeypatch):
    """E1 over markers that are all alike: one stays and no linked pair is made."""
    from genoframe.operators import ibd

    monkeypatch.setattr(V, "ld_edges", lambda *a, **k: pytest.fail("linked pairs were made"))
    gts = ["0/0", "1/1", "0/1", "1/1", "0/0"]
    rows = [(p, "I", 10 * p, "A", "T", f"s{k}", gt) for p in range(1, 40) for k, gt in enumerate(gts)]
    geno = spark.createDataFrame(rows, "site_id long, chrom string, pos long, ref string, alt string, strain string, gt string")
    assert [r.site_id for r in ibd.ibd_marker_ld_filter(geno).collect()] == [1]


def test_regions_of_masks_built_from_calls(spark):
    """C1-C3 feed D17 under the usual 200 shuffle partitions: the union in the gap fill
    must not count as dealt by strain."""
    from genoframe.operators import divergent as D

    lengths = spark.createDataFrame([("I", 60_000)], "chrom string, chrom_length long")
    calls = [(s, "I", p, "A", "1/1") for s in "wx" for p in range(20_001, 32_000, 50)]
    geno = spark.createDataFrame(calls, "strain string, chrom string, pos long, ref string, gt string")
    reads = [(s, "I", p, p + 1000) for s in "wx" for p in range(0, 60_000, 1000)]
    aligned = spark.createDataFrame(reads, "strain string, chrom string, start_pos long, end_pos long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = D.divergent_regions(I.mask_from_calls(geno, aligned, lengths)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got)) == [(s, "I", 20_000, 12_000, 32_000) for s in "wx"]


def test_views_spread_small_files(spark, tmp_path, monkeypatch):
    """A file that one task would read is dealt by its rows before a view multiplies them."""
    from genoframe.sources import fixtures

    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 50)
    names = "'n' || id n_name, id n_nationkey"
    spark.range(4).selectExpr(*names.split(", ")).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1, 201).selectExpr("id p_partkey", "cast(id % 50 as int) p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    geno = fixtures.fixture(spark, str(tmp_path), "f_geno")
    assert geno.rdd.getNumPartitions() == 4 and geno.count() == 800


def test_partitioned_writes_are_dealt_by_size(spark, tmp_path):
    """Before, every task of the source sorted all its rows and wrote to every folder."""
    from genoframe.sources import io

    rows = spark.range(1000).selectExpr("id v", "concat('s', id % 3) strain").repartition(4)
    io.write_table(rows, f"{tmp_path}/out", partition_by=["strain"])
    assert [len([*f.glob("part-*")]) for f in sorted((tmp_path / "out").glob("strain=*"))] == [1, 1, 1]
    assert spark.read.csv(f"{tmp_path}/out", sep="\t", header=True).count() == 1000


def test_bins_are_dealt_by_their_number(spark, monkeypatch):
    """As many partitions as the bins ask for, and one sort for each direction of a pass."""
    from genoframe.operators import divergent as D

    monkeypatch.setattr(D, "BINS_PER_TASK", 100)
    mask = spark.range(700).selectExpr(
        "concat('s', id % 7) strain", "'I' chrom", "id div 7 * 1000 start_bin", "id div 7 * 1000 + 1000 end_bin", "id % 20 var_count", "10.0D coverage"
    )
    out = D.gap_joined_clusters(mask, ["I"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert ", 7), REPARTITION_BY_NUM" in plan
    assert out.count() == 700


def test_frequency_window_is_dealt_by_the_number_of_bins(spark, monkeypatch):
    """The shuffle on the bin key is not dealt by its compressed bytes."""
    from genoframe.operators import divergent as D

    monkeypatch.setattr(D, "BINS_PER_TASK", 100)
    mask = spark.range(2 * 400).selectExpr(
        "concat('S', id % 2) AS strain", "'I' AS chrom", "1000 * floor(id / 2) AS start_bin", "1000 * floor(id / 2) + 1000 AS end_bin",
        "if(floor(id / 2) % 40 < 12, 30L, 1L) AS var_count", "20.0D AS coverage",
    )
    bins = D.divergent_bins(mask)
    plan = bins._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^()]*start_bin#\d+L, end_bin#\d+L, 8\), REPARTITION_BY_NUM", plan)
    rows = bins.collect()
    assert len(rows) == 2 * 10 * 12 and {r.freq for r in rows} == {1.0}
    sizes = {r.freq_bin: r.size_kb for r in D.total_divergent_size(bins).collect()}
    assert sizes == {"Common": 0.12, "All": 0.12} and D.bins_by_class(bins).count() == 2 * 120


def test_stretches_of_a_contig_are_clustered_apart(spark, monkeypatch):
    """No task of D4-D7 holds a contig, and every bin gets what it gets in one piece."""
    from genoframe.operators import divergent as D

    monkeypatch.setattr(D, "BINS_PER_TASK", 1000)
    rnd, rows = random.Random(11), []
    for strain in ("A", "B"):
        at = 0
        while at < 9000:  # runs of 1 to 30 bins, gaps of 1 to 40, some bins missing, some twice
            for count, size in ((20, rnd.choice([1, 2, 8, 9, 10, 30])), (1, rnd.choice([1, 2, 3, 4, 5, 6, 7, 40]))):
                for _ in range(size):
                    copies = rnd.choice([0, 1, 1, 1, 1, 1, 1, 2])
                    rows += [(strain, "I", at * 1000, at * 1000 + 1000, count, 20.0)] * copies
                    at += 1
        rows += [(strain, "I", None, None, 20, 20.0)] * 3
        rows += [(strain, "II", i * 1000, i * 1000 + 1000, 1, 20.0) for i in range(5000)]
    mask = spark.createDataFrame(rows, "strain string, chrom string, start_bin long, end_bin long, var_count int, coverage double")
    flagged = D.two_flank_rescue(D.classify_bins(D.coverage_fraction(mask)), ["I", "II"]).select(*D._BIN_COLS)
    want = D.cluster_bins(D.fill_gaps(D.cluster_bins(flagged)).select(*D._BIN_COLS))
    got = D.gap_joined_clusters(mask, ["I", "II"])
    held = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(held) < 4500 and len(held) > 10  # before: a contig of 9,000 bins in one task
    columns = ["strain", "chrom", "start_bin", "div_class", "div_id", "cluster", "cluster_start", "cluster_size", "cluster_end"]
    assert got.select(*columns).exceptAll(want.select(*columns)).isEmpty()
    assert got.count() == len(rows) == want.count()
    assert got.filter("div_id = 'gap'").count() > 20


def test_pca_input_merges_records_once(spark, monkeypatch):
    """G1: pruning and the filters after it read the stored merged records."""
    from genoframe.operators import pca as P
    from genoframe.sources import fixtures

    geno = fixtures.fixture(spark, "/root/testdata/sf0.001", "f_geno")
    out = P.pca_input(geno, 0.8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan and "collect_list" not in plan  # before: merged again in each branch
    assert out.count() > 0


def test_lone_records_are_merged_like_the_rest(spark):
    """A position with one record gives what it gives beside a second strain's repeated call."""
    calls = ["0/1", "1|2", "./.", ".|2", "2/2/1", "1", None]
    lone = [("I", 100, "A", "T,C", f"S{i}", c) for i, c in enumerate(calls)]
    again = lone + [("I", 100, "A", "T,C", "T", "0/0")] * 2  # a repeated strain: the general way
    schema = "chrom string, pos long, ref string, alt string, strain string, gt string"
    got, want = (
        {(r.strain, r.ref, r.alt, r.gt, r.site_id) for r in V.merge_multiallelic(spark.createDataFrame(x, schema)).collect() if r.strain != "T"}
        for x in (lone, again)
    )
    assert got == want
    assert {r[3] for r in got} == {"0/2", "2/1", "./.", "./1", "1/1/2", "2", None}
