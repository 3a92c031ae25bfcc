"""PCA, relatedness and their parameter sweep (inventory G1-G9).

* G2: per-site normalisation with site windows (one shuffle on the site).
* G3: the genetic relationship matrix (1/m) Z'Z as a block GEMM: sites are
  cut into chunks, each chunk's Z'Z (n x n, n = samples) is computed in
  numpy and only those partials are shuffled and summed.
* G4: leading eigenpairs by block Lanczos (:mod:`eigen`): tasks multiply their
  share of the matrix with a narrow block; sign fixed by the largest loading.
* G5: outlier removal refits from chunks of dosages; samples x axes numbers
  come back to the driver in each round.
* G6-G8: Tracy-Widom statistics, variance explained and PC-pair tables are
  windows over the eigenvalue table (one row per axis).
* G9: LD thresholds are a grouping column of the pruning and bits of a site's
  tag afterwards, so every job serves all thresholds, and one chain of outlier
  rounds serves every number of iterations.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import genotype as G
from ..functions.ranking import block_rank
from ..session import ship_package, stored
from . import eigen as E
from . import variants as V

# Smartpca settings of the reference (numoutevec, outlier rule).
NUM_EVEC = 50
OUTLIER_EVEC = 10
OUTLIER_SIGMA = 6.0
OUTLIER_ITER = 5
N_VAR_EXPLAINED = 10
N_PC_PAIRS = 6  # PC1..PC6 -> 15 scatter panels


# --------------------------------------------------------------------- G1
def pca_input(geno: DataFrame, ld: float, drop_x: bool = True, drop_singletons: bool = True) -> DataFrame:
    """G1: nuclear contigs -> merge records -> SNP -> biallelic -> LD prune at
    ``ld`` -> singletons out (if asked for) -> complete sites.  Returns genotypes.

    The merged records are stored: pruning and the filters after it read them
    several times, and merging costs more than all of these."""
    snp = stored(pca_snps(geno, drop_x), "pca-snps")
    kept = V.ld_prune(snp, ld).select("site_id")
    g = snp.join(kept, "site_id", "left_semi")
    if drop_singletons:
        g = V.exclude_sites(g, V.singletons(g))
    return V.complete_sites(g)


def pca_snps(geno: DataFrame, drop_x: bool = True) -> DataFrame:
    """Merged biallelic SNP records of the nuclear contigs."""
    g = V.filter_regions(geno)
    if drop_x:
        g = g.filter(F.col("chrom") != "X")
    return V.biallelic_sites(V.filter_snps(V.merge_multiallelic(g)))


def pca_sites(geno: DataFrame) -> DataFrame:
    """The SQL-checkable core of G1: biallelic SNP sites with every call made."""
    return V.complete_sites(V.biallelic_sites(V.filter_snps(geno)))


# --------------------------------------------------------------------- G2
def normalize_genotypes(geno: DataFrame) -> DataFrame:
    """z = (g - mean) / sqrt(p (1 - p)), p = (1 + sum g) / (2 + 2 n) over
    the n samples called at the site (``altnormstyle: NO``); missing -> 0."""
    d = geno.select("site_id", "chrom", "pos", "strain", G.dosage("gt").alias("g"))
    w = Window.partitionBy("site_id")
    s = F.sum("g").over(w)
    n = F.count("g").over(w)
    p = (1 + s) / (2 + 2 * n)
    z = (F.col("g") - s / n) / F.sqrt(p * (1 - p))
    return d.withColumn("z", F.coalesce(z, F.lit(0.0)))


# --------------------------------------------------------------------- G3
_GRM = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("zz", T.DoubleType()),
        T.StructField("m", T.LongType()),
    ]
)


def _chunk_gram(pdf: pd.DataFrame) -> pd.DataFrame:
    z = np.array(pdf["zs"].tolist(), dtype=np.float64)  # m x n
    gram = z.T @ z
    ii, jj = np.triu_indices(z.shape[1])
    return pd.DataFrame({"i": ii.astype(np.int32), "j": jj.astype(np.int32), "zz": gram[ii, jj], "m": np.int64(z.shape[0])})


def strain_index(geno: DataFrame) -> DataFrame:
    s = geno.select("strain").distinct()
    return s.withColumn("sidx", (F.row_number().over(Window.orderBy("strain")) - 1).cast("int"))


def relatedness(geno: DataFrame, chunk: int = 4096) -> DataFrame:
    """GRM entry (1/m) sum_sites z_i z_j for every strain pair (i <= j),
    with the marker count m."""
    ship_package(geno.sparkSession)
    z = normalize_genotypes(geno)
    strains = strain_index(geno)
    n = strains.agg(F.count(F.lit(1))).scalar()
    per_site = z.join(strains, "strain").groupBy("site_id", "chrom", "pos").agg(
        F.collect_list(F.struct("sidx", "z")).alias("_e")
    )
    per_site = per_site.withColumn("_n", n.cast("int")).withColumn("zs", G.dense("_e", "_n", "z", F.lit(0.0))).drop("_e", "_n")
    ranked = block_rank(per_site.select("site_id", "chrom", "pos", "zs"), "chrom", "pos", "idx", tiebreak="site_id")
    ranked = ranked.withColumn("chunk", F.floor((F.col("idx") - 1) / chunk).cast("bigint"))
    parts = ranked.select("chrom", "chunk", "zs").groupBy("chrom", "chunk").applyInPandas(_chunk_gram, _GRM)
    # every chunk reports every pair, so a pair's summed count is the marker total
    tot = parts.groupBy("i", "j").agg(F.sum("zz").alias("zz"), F.sum("m").alias("markers"))
    s1 = strains.select(F.col("sidx").alias("i"), F.col("strain").alias("strain1"))
    s2 = strains.select(F.col("sidx").alias("j"), F.col("strain").alias("strain2"))
    return tot.join(s1, "i").join(s2, "j").select(
        "strain1", "strain2", (F.col("zz") / F.col("markers")).alias("grm"), "markers"
    )


# --------------------------------------------------------------------- G4
_EIG = T.StructType(
    [
        T.StructField("strain", T.StringType()),
        T.StructField("pc", T.IntegerType()),
        T.StructField("eigenvalue", T.DoubleType()),
        T.StructField("loading", T.DoubleType()),
    ]
)


def pca(grm: DataFrame, k: int = NUM_EVEC) -> DataFrame:
    """Top-k eigenvalues and eigenvectors of the GRM, long form
    (strain, pc, eigenvalue, loading), by block Lanczos over the stored pair
    rows: every task multiplies its rows, none holds the n x n matrix."""
    spark = grm.sparkSession
    ship_package(spark)
    pairs = stored(grm.select("strain1", "strain2", "grm"), "grm-pairs")
    ends = pairs.select(F.explode(F.array("strain1", "strain2")).alias("strain")).distinct()
    names = sorted(r.strain for r in ends.collect())  # one name a sample
    if not names:
        return spark.createDataFrame([], _EIG)
    index = {name: i for i, name in enumerate(names)}
    values, vectors = E.leading({0: E.Problem(len(names), k)}, E.matrix_product(pairs, index))[0]
    return spark.createDataFrame(_axes(names, values, vectors), _EIG)


def _axes(names: list[str], values: np.ndarray, vectors: np.ndarray) -> list[tuple]:
    """(strain, pc, eigenvalue, loading): samples x axes rows."""
    return [
        (name, c + 1, float(value), float(vectors[i, c])) for c, value in enumerate(values) for i, name in enumerate(names)
    ]


def spectrum_totals(grm: DataFrame, *by: str) -> DataFrame:
    """(trace, frob, axes) of a GRM given as pairs i <= j: the sum of all its
    eigenvalues, the sum of their squares and the rank n - 1 that centring
    leaves.  With them, sums over the tail of the spectrum need only the
    leading eigenvalues."""
    same = F.col("strain1") == F.col("strain2")
    sq = F.col("grm") * F.col("grm")
    return grm.groupBy(*by).agg(
        F.sum(F.when(same, F.col("grm")).otherwise(0.0)).alias("trace"),
        F.sum(F.when(same, sq).otherwise(2 * sq)).alias("frob"),
        (F.sum(same.cast("bigint")) - 1).alias("axes"),
    )


def eigenvalues(pcs: DataFrame) -> DataFrame:
    return pcs.groupBy("pc").agg(F.first("eigenvalue").alias("eigenvalue")).select(
        F.col("pc").cast("bigint").alias("n"), "eigenvalue"
    )


# --------------------------------------------------------------------- G5
def pca_outlier_removal(
    geno: DataFrame,
    iterations: int = OUTLIER_ITER,
    n_evec: int = OUTLIER_EVEC,
    sigma: float = OUTLIER_SIGMA,
    k: int = NUM_EVEC,
) -> tuple[DataFrame, DataFrame]:
    """Refit after dropping strains further than ``sigma`` standard
    deviations from the mean on any of the top ``n_evec`` axes, at most
    ``iterations`` times.  Returns (removed strains with their iteration,
    final PCs)."""
    spark = geno.sparkSession
    ship_package(spark)
    chunks, strains = E.site_chunks(geno)
    fits, removed = E.removal_chain(chunks, strains, [0], iterations, k, n_evec, sigma)
    gone = spark.createDataFrame(sorted(removed[0].items()), "strain string, iteration int")
    if not fits[0]:
        return gone, spark.createDataFrame([], _EIG)
    last = fits[0][-1]
    return gone, spark.createDataFrame(_axes([strains[i] for i in last.active], last.values, last.vectors), _EIG)


# --------------------------------------------------------------------- G6
def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function by its power series."""
    if x <= 0:
        return 1.0
    term = total = 1.0 / a
    for k in range(1, 2000):
        term *= x / (a + k)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, max(0.0, 1.0 - math.exp(a * math.log(x) - x - math.lgamma(a)) * total))


@F.pandas_udf(T.DoubleType())
def tracy_widom_p(stat: pd.Series) -> pd.Series:
    """Upper tail of the Tracy-Widom law (beta = 1), approximated by a shifted
    gamma law (Chiani 2014).  For the axis table: one row per axis."""
    # Shape, scale and shift of the published fit.
    shape, scale, shift = 46.446, 0.186054, 9.84801
    return stat.map(lambda s: None if pd.isna(s) else _gamma_upper(shape, (s + shift) / scale))


def tracy_widom(eig: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per axis N: eigenvalue, difference to the previous axis, the
    Tracy-Widom statistic over the eigenvalues from N on, and the effective
    number of markers (Patterson et al. 2006).  One row per axis; the
    windows run over the eigenvalue table (bounded by the sample count)."""
    if totals is None:  # the whole spectrum is given; its null space is relative to the trace
        trace = eig.agg(F.sum("eigenvalue")).scalar()
        eig = eig.filter(F.col("eigenvalue") > 1e-9 * trace)
        totals = eig.agg(F.sum("eigenvalue").alias("trace"), F.sum(F.col("eigenvalue") ** 2).alias("frob"), F.count("*").alias("axes"))
    # sums over the eigenvalues from N on: the totals less what comes before N
    before = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    lead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    df = eig.withColumn("_s1", totals.select("trace").scalar() - lead(F.col("eigenvalue")))
    df = df.withColumn("_s2", totals.select("frob").scalar() - lead(F.col("eigenvalue") ** 2))
    df = df.withColumn("_r", (totals.select("axes").scalar() - F.col("n") + 1).cast("double")).filter("_r >= 1")  # = m - 1
    m = F.col("_r") + 1
    neff = F.try_divide((m + 1) * F.col("_s1") ** 2, (m - 1) * F.col("_s2") - F.col("_s1") ** 2)
    ell = (m - 1) * F.col("eigenvalue") / F.col("_s1")
    a = F.sqrt(neff - 1) + F.sqrt(m)
    mu = F.try_divide(a * a, neff)
    sig = F.try_divide(a, neff) * F.pow(F.try_divide(F.lit(1.0), F.sqrt(neff - 1)) + 1 / F.sqrt(m), F.lit(1.0 / 3.0))
    prev = F.lag("eigenvalue").over(Window.orderBy("n"))
    return df.select(
        "n",
        "eigenvalue",
        (F.col("eigenvalue") - prev).alias("difference"),
        F.try_divide(ell - mu, sig).alias("twstat"),
        neff.alias("effect_n"),
    ).withColumn("p_value", tracy_widom_p("twstat"))


# --------------------------------------------------------------------- G7
def variance_explained(eig: DataFrame, top: int = N_VAR_EXPLAINED, totals: DataFrame | None = None) -> DataFrame:
    """Eigenvalue / sum, cumulative, label ``PC<N>``, first ``top`` axes.
    The sum is the trace in ``totals``, or that of ``eig`` if it is complete."""
    total = F.sum("eigenvalue").over(Window.partitionBy()) if totals is None else totals.select("trace").scalar()
    cum = F.sum("eigenvalue").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = eig.select(
        "n",
        F.concat(F.lit("PC"), F.col("n").cast("string")).alias("label"),
        (F.col("eigenvalue") / total).alias("var_exp"),
        (cum / total).alias("cum_var_exp"),
    )
    return df.filter(F.col("n") <= top)


# --------------------------------------------------------------------- G8
def pc_pairs(pcs_wide: DataFrame, var_exp: DataFrame, highlight: list[str] | None = None, n_pc: int = N_PC_PAIRS) -> DataFrame:
    """Long scatter table of the 15 PC pairs (a < b) of PC1..PC6 with axis
    labels ``PCa (x.xx%)`` and a highlight flag.  Pairs come from a fixed
    generator per strain row (the 6 PCs), not from a self-join."""
    pairs = [(a, b) for a in range(1, n_pc + 1) for b in range(a + 1, n_pc + 1)]
    arr = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"pc{a}").alias("x"), F.col(f"pc{b}").alias("y"))
            for a, b in pairs
        ]
    )
    long = pcs_wide.select("strain", F.explode(arr).alias("p")).select("strain", "p.a", "p.b", "p.x", "p.y")
    lab = var_exp.select(
        F.col("n").alias("_n"),
        F.concat(F.col("label"), F.lit(" ("), F.format_number(F.round(F.col("var_exp") * 100, 2), 2), F.lit("%)")).alias("_lab"),
    )
    la = lab.select(F.col("_n").alias("a"), F.col("_lab").alias("x_label"))
    lb = lab.select(F.col("_n").alias("b"), F.col("_lab").alias("y_label"))
    hl = F.col("strain").isin(highlight) if highlight else F.lit(False)
    return long.join(la, "a", "left").join(lb, "b", "left").select(
        "strain",
        F.concat(F.lit("PC"), F.col("a").cast("string")).alias("x_pc"),
        F.concat(F.lit("PC"), F.col("b").cast("string")).alias("y_pc"),
        "x",
        "y",
        "x_label",
        "y_label",
        hl.alias("highlight"),
    )


def pcs_wide(pcs: DataFrame, n_pc: int = N_PC_PAIRS) -> DataFrame:
    """Long PCs -> strain, pc1..pcN (the ``.evac`` layout)."""
    return pcs.filter(F.col("pc") <= n_pc).groupBy("strain").pivot("pc", list(range(1, n_pc + 1))).agg(
        F.first("loading")
    ).select("strain", *[F.col(str(i)).alias(f"pc{i}") for i in range(1, n_pc + 1)])


# --------------------------------------------------------------------- G9
def parameter_sweep(geno: DataFrame, ld_values: list[float], outlier_iters: list[int]) -> DataFrame:
    """Every (LD threshold, outlier iterations) setting with the number of
    sites its LD pruning keeps.  The threshold is a grouping column: one r^2
    pass and one pruning job serve every threshold."""
    g = stored(pca_snps(geno, drop_x=False), "sweep-snps")
    kept = V.ld_prune_sweep(g, ld_values)
    counts = kept.groupBy("ld").agg(F.count(F.lit(1)).alias("kept_sites"))
    iters = F.explode(F.array(*[F.lit(int(x)) for x in outlier_iters])).alias("outlier_iterations")
    return counts.select("ld", iters, "kept_sites")


# --------------------------------------------------------------------- G9 (PCA per setting)
_SWEPT = "ld double, outlier_iterations int, strain string, removed_at int, pc int, eigenvalue double, var_exp double, loading double"


def sweep_chunks(geno: DataFrame, ld_values: list[float], drop_x: bool = True, drop_singletons: bool = True) -> tuple[DataFrame, list[str]]:
    """The sites of all settings as chunks; bit i of a site's tag says that
    pruning at ``ld_values[i]`` keeps it.  Pruning runs once for all thresholds;
    singleton and completeness filters do not depend on the threshold."""
    snp = stored(pca_snps(geno, drop_x), "pca-snps")
    bit = F.create_map(*[F.lit(x) for i, t in enumerate(ld_values) for x in (float(t), 1 << i)])
    kept = V.ld_prune_sweep(snp, ld_values)
    tags = kept.groupBy("site_id").agg(F.sum(F.element_at(bit, F.col("ld"))).cast("bigint").alias("tag"))
    base = V.exclude_sites(snp, V.singletons(snp)) if drop_singletons else snp
    return E.site_chunks(V.complete_sites(base), tags)


def pca_outlier_sweep(
    geno: DataFrame,
    ld_values: list[float],
    outlier_iters: list[int],
    k: int = N_VAR_EXPLAINED,
    n_evec: int = OUTLIER_EVEC,
    sigma: float = OUTLIER_SIGMA,
    drop_x: bool = True,
    drop_singletons: bool = True,
) -> DataFrame:
    """The PCA of every (LD threshold, outlier iterations) setting: (ld,
    outlier_iterations, strain, removed_at, pc, eigenvalue, var_exp, loading).
    A strain removed at iteration r has one row with ``removed_at`` = r and no
    axis.  All thresholds advance together over one chunk table, and the run
    with most iterations contains those with fewer."""
    spark = geno.sparkSession
    ship_package(spark)
    chunks, strains = sweep_chunks(geno, ld_values, drop_x, drop_singletons)
    keys = list(range(len(ld_values)))
    fits, removed = E.removal_chain(chunks, strains, keys, max(outlier_iters, default=0), k, n_evec, sigma)
    rows: list[tuple] = []
    for key, iters in ((key, iters) for key in keys for iters in outlier_iters if fits[key]):
        fit = fits[key][min(iters, len(fits[key]) - 1)]
        setting = float(ld_values[key]), int(iters)
        for strain, pc, value, loading in _axes([strains[i] for i in fit.active], fit.values, fit.vectors):
            rows.append((*setting, strain, None, pc, value, value / fit.trace if fit.trace else None, loading))
        rows += [(*setting, strain, at, None, None, None, None) for strain, at in removed[key].items() if at <= iters]
    return spark.createDataFrame(rows, _SWEPT)


def pca_sweep(geno: DataFrame, ld_values: list[float], k: int = N_VAR_EXPLAINED, drop_x: bool = True) -> DataFrame:
    """G9 with G1-G4 per LD setting, without outlier removal: (ld, pc,
    eigenvalue, var_exp) for the top ``k`` axes."""
    swept = pca_outlier_sweep(geno, ld_values, [0], k, drop_x=drop_x)
    return swept.groupBy("ld", "pc").agg(F.first("eigenvalue").alias("eigenvalue"), F.first("var_exp").alias("var_exp"))
