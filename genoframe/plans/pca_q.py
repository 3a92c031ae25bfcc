"""PCA and relatedness queries (G1-G9) over ``f_geno``.

G2 and G3 are checked against SQL on the complete biallelic SNP sites.  The
eigen step and everything computed from its output (G4-G8), the greedy LD
pruning (G1, G9) and the outlier loop (G5) have no SQL form; they are checked
by invariants in ``tests/`` (orthonormality, eigen residual, the formulas of
G6-G8 against DuckDB on fixed eigenvalue / PC tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import pca as P
from ..session import stored
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register

# The reference's debug sweep (LD 0.8,0.6) and default outlier iterations.
SWEEP_LD = [0.8, 0.6]
SWEEP_OUTLIER_ITERS = [5]

_G = [
    ("ga", "SELECT g.*, NULLIF(split_part(gt, '/', 1), '.') AS a1, NULLIF(split_part(gt, '/', 2), '.') AS a2 FROM f_geno g"),
    ("bs", "SELECT site_id FROM f_site WHERE length(ref) = 1 AND length(alt) = 1"),
    ("miss", "SELECT DISTINCT site_id FROM ga WHERE a1 IS NULL OR a2 IS NULL"),
    (
        "dg",
        "SELECT site_id, strain, CAST(a1 <> '0' AS INT) + CAST(a2 <> '0' AS INT) AS g FROM ga "
        "WHERE site_id IN (SELECT site_id FROM bs) AND site_id NOT IN (SELECT site_id FROM miss)",
    ),
    ("sn", "SELECT site_id, SUM(g) AS s, COUNT(g) AS n FROM dg GROUP BY site_id"),
    (
        "zt",
        "SELECT dg.site_id, dg.strain, (dg.g - sn.s / sn.n) / sqrt(((1 + sn.s) / (2 + 2 * sn.n)) * (1 - (1 + sn.s) / (2 + 2 * sn.n))) AS z "
        "FROM dg JOIN sn ON sn.site_id = dg.site_id",
    ),
]


def _sql(body: str) -> str:
    return with_fixtures(["f_geno", "f_site"], body, _G)


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pca_sites(fixture(spark, sf_dir, "f_geno"))


@register("normalize_genotypes", _sql("SELECT site_id, strain, ROUND(z, 6) AS z FROM zt"), "G")
def q_normalize_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.normalize_genotypes(_sites(spark, sf_dir)).select("site_id", "strain", F.round("z", 6).alias("z"))


@register(
    "relatedness",
    _sql(
        "SELECT a.strain AS strain1, b.strain AS strain2, ROUND(SUM(a.z * b.z) / COUNT(*), 6) AS grm, COUNT(*) AS markers "
        "FROM zt a JOIN zt b ON a.site_id = b.site_id AND a.strain <= b.strain GROUP BY a.strain, b.strain"
    ),
    "G",
)
def q_relatedness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.relatedness(_sites(spark, sf_dir)).withColumn("grm", F.round("grm", 6))


def _input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genotypes that enter the PCA: G1 at LD 0.8."""
    return stored(P.pca_input(fixture(spark, sf_dir, "f_geno"), SWEEP_LD[0]), "pca-input")


def _grm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(P.relatedness(_input(spark, sf_dir)), "grm")


def _pcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pca(_grm(spark, sf_dir))


@register("pca", None, "G")
def q_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 50 eigenvectors / eigenvalues of the GRM (long form)."""
    return _pcs(spark, sf_dir).withColumn("eigenvalue", F.round("eigenvalue", 6)).withColumn("loading", F.round("loading", 6))


@register("pca_outlier_removal", None, "G")
def q_pca_outlier_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every strain with the iteration that removed it (NULL if kept) and
    its final PC1..PC6 (NULL if removed)."""
    g = _input(spark, sf_dir)
    removed, final = P.pca_outlier_removal(g)
    strains = g.select("strain").distinct()
    wide = P.pcs_wide(final)
    return strains.join(removed.withColumnRenamed("iteration", "removed_iteration"), "strain", "left").join(wide, "strain", "left")


def planted(geno: DataFrame, every: int = 3) -> DataFrame:
    """``geno`` with the first two strains as outliers: at every third site they
    carry an allele that few others keep (by a hash, so that LD stays low)."""
    names = geno.select("strain").distinct().withColumn("_no", F.dense_rank().over(Window.orderBy("strain")))
    pair = names.select(F.max(F.when(F.col("_no") <= 2, F.col("strain")))).scalar()
    chosen = F.col("site_id") % every == 0
    lost = F.pmod(F.xxhash64("site_id", "strain"), F.lit(10)) >= 3
    gt = F.when(chosen & (F.col("strain") <= pair), "1/1").when(chosen & lost, "0/0").otherwise(F.col("gt"))
    return geno.withColumn("gt", gt)


@register("pca_outlier_sweep", None, "G")
def q_pca_outlier_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 over LD thresholds and outlier iterations, with planted outliers; 25
    strains cannot be 6 standard deviations away, so the bound is 3."""
    geno = planted(fixture(spark, sf_dir, "f_geno"))
    swept = P.pca_outlier_sweep(geno, SWEEP_LD, [0, 1, 5], n_evec=2, sigma=3.0)
    return swept.select(
        "ld", "outlier_iterations", "strain", "removed_at", "pc", *[F.round(c, 6).alias(c) for c in ("eigenvalue", "var_exp", "loading")]
    )


@register("tracy_widom", None, "G")
def q_tracy_widom(spark: SparkSession, sf_dir: str) -> DataFrame:
    grm = _grm(spark, sf_dir)
    return P.tracy_widom(P.eigenvalues(P.pca(grm)), P.spectrum_totals(grm))


@register("variance_explained", None, "G")
def q_variance_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    grm = _grm(spark, sf_dir)
    return P.variance_explained(P.eigenvalues(P.pca(grm)), totals=P.spectrum_totals(grm))


@register("pc_pairs", None, "G")
def q_pc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    grm = _grm(spark, sf_dir)
    pcs = stored(P.pca(grm), "pcs")
    explained = stored(P.variance_explained(P.eigenvalues(pcs), totals=P.spectrum_totals(grm)), "var-exp")
    return P.pc_pairs(P.pcs_wide(pcs), explained)


@register("parameter_sweep", None, "G")
def q_parameter_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parameter_sweep(fixture(spark, sf_dir, "f_geno"), SWEEP_LD, SWEEP_OUTLIER_ITERS)


@register("pca_input", None, "G")
def q_pca_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 at LD 0.8: genotypes that enter the PCA."""
    return P.pca_input(fixture(spark, sf_dir, "f_geno"), 0.8).select("site_id", "strain", "gt")


@register("pca_sweep", None, "G")
def q_pca_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 with G1-G4 per LD setting (top-10 axes per setting)."""
    df = P.pca_sweep(fixture(spark, sf_dir, "f_geno"), SWEEP_LD)
    return df.withColumn("eigenvalue", F.round("eigenvalue", 6)).withColumn("var_exp", F.round("var_exp", 6))
