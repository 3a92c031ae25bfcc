"""Components along an axis against brute force, and what the plan carries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from genoframe.operators import connectivity as C
from genoframe.operators import haplotypes as H
from genoframe.sources.fixtures import fixture

SCHEMA = "chrom string, strain1 string, strain2 string, lo long, hi long"


def brute(edges, chrom, rank):
    label = {s: s for e in edges for s in e[1:3]}
    live = [(x, y) for c, x, y, lo, hi in edges if c == chrom and lo <= rank <= hi]
    for _ in label:
        for x, y in live:
            label[x] = label[y] = min(label[x], label[y])
    return label


@pytest.mark.parametrize("bits", [2, 4, 10])
def test_runs_equal_components_of_every_rank(spark, bits):
    rnd, top = random.Random(bits), 150
    strains = [f"s{i:02d}" for i in range(12)]
    edges = []
    for _ in range(60):
        lo = rnd.randrange(1, top)
        hi = min(top, lo + rnd.choice([0, 1, 3, 15, 16, 63, 120]))
        edges.append((rnd.choice(["I", "II"]), *rnd.sample(strains, 2), lo, hi))
    edges += [("I", "s00", "s11", 1, top), ("I", "s01", "s02", 16, 31), ("I", "s01", "s02", 16, 31), ("II", "s03", "s03", 1, 9)]
    got = {}
    runs = C.component_runs(spark.createDataFrame(edges, SCHEMA), bits).collect()
    for r in runs:
        for rank in range(r.first, r.last + 1):
            assert (r.chrom, rank, r.strain) not in got
            got[r.chrom, rank, r.strain] = r.component
    for chrom in ("I", "II"):
        for rank in range(1, top + 1):
            for strain, label in brute(edges, chrom, rank).items():
                assert got.get((chrom, rank, strain), strain) == label, (chrom, rank, strain)
    keys = sorted((r.chrom, r.strain, r.first, r.last, r.component) for r in runs)
    for a, b in zip(keys, keys[1:]):  # runs are maximal
        assert not (a[:2] == b[:2] and a[3] + 1 == b[2] and a[4] == b[4])


def test_a_long_edge_enters_few_rows(spark):
    """A clique over 4,096 blocks: each block gets a spanning forest, not the clique."""
    n, last = 6, (1 << 14) - 1
    clique = [("I", f"s{i}", f"s{j}", 0, last) for i in range(n) for j in range(i)]
    cut = C.block_edges(spark.createDataFrame(clique, SCHEMA), bits=2)
    assert cut.groupBy("blk").count().agg(F.max("count")).first()[0] == n - 1
    assert cut.select("blk").distinct().count() == 4096
    runs = C.component_runs(spark.createDataFrame(clique, SCHEMA), bits=2)
    assert sorted(map(tuple, runs.collect())) == [("I", f"s{i}", 0, last, "s0") for i in range(1, n)]


def test_no_edges(spark):
    assert C.component_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ten_times_the_segments_do_not_make_ten_times_the_rows_an_interval(spark, sf_dir):
    """Rows into the solver stay near two per segment; (segment, interval) pairs grow with both."""
    seg = fixture(spark, sf_dir, "f_seg")
    tenfold = seg.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumns(
        {"start_pos": F.col("start_pos") + F.col("_k") * 37, "stop_pos": F.col("stop_pos") + F.col("_k") * 41}
    ).drop("_k")
    for table in (seg, tenfold):
        ranks = H.covered_ranks(table)
        assert C.block_edges(ranks).count() < 3 * table.count()
    pairs = H.covered_ranks(tenfold).agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0]
    assert pairs > 10 * C.block_edges(H.covered_ranks(tenfold)).count()
