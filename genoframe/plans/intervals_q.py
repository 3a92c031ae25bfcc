"""Interval queries (A4, C1-C4) over ``f_geno``, ``f_align``, ``f_chrom``, ``f_seg`` and ``f_annot``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import intervals as I
from ..operators import divergent as D
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register
from .divergent_q import _base_ctes

_BINS = [
    ("bins0", "SELECT chrom, chrom_length, UNNEST(range(0, chrom_length, 1000)) AS start_bin FROM f_chrom"),
    ("bins", "SELECT chrom, start_bin, LEAST(start_bin + 1000, chrom_length) AS end_bin FROM bins0"),
]


@register("make_bins", with_fixtures(["f_chrom"], "SELECT chrom, start_bin, end_bin FROM bins", _BINS), "A")
def q_make_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.make_bins(fixture(spark, sf_dir, "f_chrom"))


_COUNT = _BINS + [
    ("grid", "SELECT s.strain, b.* FROM (SELECT DISTINCT strain FROM f_geno) s CROSS JOIN bins b"),
    (
        "carriers",
        "SELECT strain, chrom, pos, ref FROM f_geno WHERE COALESCE(NULLIF(split_part(gt, '/', 1), '.') <> '0', FALSE) "
        "OR COALESCE(NULLIF(split_part(gt, '/', 2), '.') <> '0', FALSE)",
    ),
    (
        "cnt",
        "SELECT g.strain, g.chrom, g.start_bin, g.end_bin, COUNT(c.pos) AS var_count FROM grid g LEFT JOIN carriers c "
        "ON c.strain = g.strain AND c.chrom = g.chrom AND c.pos - 1 < g.end_bin AND c.pos - 1 + length(c.ref) > g.start_bin "
        "GROUP BY g.strain, g.chrom, g.start_bin, g.end_bin",
    ),
]


@register("interval_count", with_fixtures(["f_geno", "f_chrom"], "SELECT * FROM cnt", _COUNT), "C")
def q_interval_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_count(fixture(spark, sf_dir, "f_geno"), fixture(spark, sf_dir, "f_chrom"))


_DEPTH = _BINS + [
    ("agrid", "SELECT s.strain, b.* FROM (SELECT DISTINCT strain FROM f_align) s CROSS JOIN bins b"),
    (
        "dep",
        "SELECT g.strain, g.chrom, g.start_bin, g.end_bin, "
        "ROUND(COALESCE(SUM(CASE WHEN a.start_pos IS NOT NULL THEN LEAST(a.end_pos, g.end_bin) - GREATEST(a.start_pos, g.start_bin) END), 0) * 100 / (g.end_bin - g.start_bin), 0) / 100 AS coverage "
        "FROM agrid g LEFT JOIN f_align a ON a.strain = g.strain AND a.chrom = g.chrom AND a.start_pos < g.end_bin AND a.end_pos > g.start_bin "
        "GROUP BY g.strain, g.chrom, g.start_bin, g.end_bin",
    ),
]


@register("interval_mean_depth", with_fixtures(["f_align", "f_chrom"], "SELECT * FROM dep", _DEPTH), "C")
def q_interval_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_mean_depth(fixture(spark, sf_dir, "f_align"), fixture(spark, sf_dir, "f_chrom"))


_MASK = _COUNT + _DEPTH[2:] + [
    (
        "mask",
        "SELECT c.strain, c.chrom, c.start_bin, c.end_bin, c.var_count, COALESCE(d.coverage, 0) AS coverage FROM cnt c LEFT JOIN dep d "
        "ON c.strain = d.strain AND c.chrom = d.chrom AND c.start_bin = d.start_bin",
    )
]


@register("assemble_mask", with_fixtures(["f_geno", "f_align", "f_chrom"], "SELECT * FROM mask", _MASK), "C")
def q_assemble_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = fixture(spark, sf_dir, "f_chrom")
    return I.mask_from_calls(fixture(spark, sf_dir, "f_geno"), fixture(spark, sf_dir, "f_align"), lengths)


def _regions_of_mask() -> list[tuple[str, str]]:
    """The region CTEs over the assembled mask instead of the mask fixture."""
    return _MASK + [(n, sql.replace("FROM f_mask", "FROM mask")) for n, sql in _base_ctes()]


@register("mask_divergent_regions", with_fixtures(["f_geno", "f_align", "f_chrom"], "SELECT * FROM reg", _regions_of_mask()), "C")
def q_mask_divergent_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count_variant_coverage -> define_divergent_region: masks built from
    calls and alignments (C1-C3) feed the region calling (D17)."""
    lengths = fixture(spark, sf_dir, "f_chrom")
    return D.divergent_regions(I.mask_from_calls(fixture(spark, sf_dir, "f_geno"), fixture(spark, sf_dir, "f_align"), lengths))


@register(
    "interval_overlap_join",
    with_fixtures(
        ["f_seg", "f_annot"],
        "SELECT s.strain1, s.ind1, s.strain2, s.ind2, s.chrom, s.start_pos, s.stop_pos, s.lod, "
        "a.start_pos AS r_start_pos, a.end_pos AS r_end_pos, a.cm AS r_cm FROM f_seg s JOIN f_annot a "
        "ON a.chrom = s.chrom AND (a.start_pos BETWEEN s.start_pos AND s.stop_pos OR a.end_pos BETWEEN s.start_pos AND s.stop_pos "
        "OR s.start_pos BETWEEN a.start_pos AND a.end_pos OR s.stop_pos BETWEEN a.start_pos AND a.end_pos)",
    ),
    "C",
)
def q_interval_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_overlap_join(fixture(spark, sf_dir, "f_seg"), fixture(spark, sf_dir, "f_annot"))
