"""Divergent-region queries (D1-D17) over the ``f_mask`` fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contigs import contig_rank_sql
from ..operators import divergent as D
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_mask")


# ------------------------------------------------------------------ oracle SQL
# Written from the rules, not from the Spark plan: D3 uses one strain-wide
# window in genome order, gap filling joins bins to cluster_end + {0..3} kb,
# islands use start - 1000 * row_number().


def _cluster_ctes(src: str, p: str) -> list[tuple[str, str]]:
    w = "PARTITION BY strain, chrom ORDER BY start_bin"
    return [
        (f"{p}1", f"SELECT *, is_div AND (COALESCE(LAG(is_div) OVER ({w}), FALSE) OR COALESCE(LEAD(is_div) OVER ({w}), FALSE)) AS cl FROM {src}"),
        (f"{p}2", f"SELECT *, CASE WHEN cl AND NOT COALESCE(LAG(cl) OVER ({w}), FALSE) THEN start_bin END AS st FROM {p}1"),
        (f"{p}3", f"SELECT *, CASE WHEN cl THEN LAST_VALUE(st IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cluster_start FROM {p}2"),
        (
            p,
            f"SELECT *, cluster_start + cluster_size AS cluster_end FROM (SELECT *, CASE WHEN NOT is_div THEN NULL WHEN cluster_start IS NULL THEN CAST(1000 AS BIGINT) "
            f"ELSE 1000 * COUNT(*) OVER (PARTITION BY strain, chrom, cluster_start) END AS cluster_size FROM {p}3)",
        ),
    ]


def _gap_ctes(src: str, p: str) -> list[tuple[str, str]]:
    return [
        (f"{p}a", f"SELECT DISTINCT strain, chrom, cluster_start, cluster_size, cluster_end FROM {src} WHERE cluster_size >= 9000"),
        (
            f"{p}b",
            f"SELECT *, LEAD(cluster_start) OVER (PARTITION BY strain, chrom ORDER BY cluster_start) AS next_start, "
            f"LEAD(cluster_end) OVER (PARTITION BY strain, chrom ORDER BY cluster_start) AS next_end FROM {p}a",
        ),
        (f"{p}", f"SELECT *, next_start - cluster_end AS gap_size, COALESCE(next_start - cluster_end > 0 AND next_start - cluster_end <= 5000, FALSE) AS joined FROM {p}b"),
    ]


def _base_ctes(rare: float = 0.01, intermediate: float = 0.05) -> list[tuple[str, str]]:
    rank = contig_rank_sql("chrom")
    part = "PARTITION BY strain ORDER BY chrom_idx, start_bin"
    ctes: list[tuple[str, str]] = [
        ("m", f"SELECT strain, chrom, start_bin, end_bin, var_count, coverage, {rank} AS chrom_idx FROM f_mask"),
        ("mc", "SELECT strain, AVG(coverage) AS mean_cov_genome FROM m GROUP BY strain"),
        (
            "c1",
            "SELECT m.*, mc.mean_cov_genome, COALESCE(m.coverage / NULLIF(mc.mean_cov_genome, 0), 0) AS fraction_cov, m.var_count > 15 AS is_count, "
            "COALESCE(m.coverage / NULLIF(mc.mean_cov_genome, 0), 0) < 0.35 AS is_lowcov FROM m JOIN mc ON m.strain = mc.strain",
        ),
        ("c2", "SELECT *, NOT (is_count OR is_lowcov) AS is_pass FROM c1"),
        (
            "c3",
            f"SELECT *, is_pass AND NOT COALESCE(LAG(is_pass) OVER ({part}), FALSE) AND NOT COALESCE(LEAD(is_pass) OVER ({part}), FALSE) AS is_tf FROM c2",
        ),
        (
            "b0",
            "SELECT strain, chrom, start_bin, end_bin, var_count, fraction_cov, "
            "CONCAT(CASE WHEN is_count THEN 'Count' ELSE '' END, CASE WHEN is_lowcov THEN 'LowCoverage' ELSE '' END, CASE WHEN is_tf THEN 'TwoFlank' ELSE '' END) AS div_id, "
            "(is_count OR is_lowcov OR is_tf) AS is_div FROM c3",
        ),
    ]
    ctes += _cluster_ctes("b0", "k")
    ctes += _gap_ctes("k", "g")
    ctes += [
        ("fill0", "SELECT strain, chrom, cluster_end, UNNEST([0, 1, 2, 3]) AS o FROM g WHERE joined"),
        ("fill", "SELECT DISTINCT strain, chrom, cluster_end + 1000 * o AS fill_start FROM fill0"),
        (
            "b1",
            "SELECT k.strain, k.chrom, k.start_bin, k.end_bin, k.var_count, k.fraction_cov, "
            "CASE WHEN NOT k.is_div AND f.fill_start IS NOT NULL THEN 'gap' ELSE k.div_id END AS div_id, "
            "(k.is_div OR f.fill_start IS NOT NULL) AS is_div FROM k LEFT JOIN fill f "
            "ON f.strain = k.strain AND f.chrom = k.chrom AND f.fill_start = k.start_bin",
        ),
    ]
    ctes += _cluster_ctes("b1", "r")
    ctes += [
        (
            "fl",
            "SELECT *, CASE WHEN div_id IN ('Count', 'CountLowCoverage') THEN 1 ELSE 0 END AS is_count, "
            "MAX(CASE WHEN div_id IN ('Count', 'CountLowCoverage') THEN 1 ELSE 0 END) OVER (PARTITION BY strain, chrom, cluster_start) AS mx "
            "FROM r WHERE cluster_size >= 9000",
        ),
        ("nstr", "SELECT COUNT(DISTINCT strain) AS n FROM f_mask"),
        (
            "fq",
            "SELECT fl.*, CAST(COUNT(*) OVER (PARTITION BY chrom, start_bin, end_bin) AS DOUBLE) / (SELECT n FROM nstr) AS freq FROM fl",
        ),
        (
            "fq2",
            f"SELECT *, CASE WHEN freq > 0.5 THEN 1 - freq ELSE freq END AS mwf, "
            f"CASE WHEN freq < {rare} THEN 'Rare' WHEN freq < {intermediate} THEN 'Intermediate' ELSE 'Common' END AS freq_bin, "
            f"CASE WHEN mx = 0 THEN 'Del' ELSE 'Pass' END AS flag_del FROM fq",
        ),
        ("fin", "SELECT * FROM fq2 WHERE flag_del = 'Pass'"),
        ("reg", "SELECT DISTINCT strain, chrom, cluster_start, cluster_size, cluster_end FROM fin"),
    ]
    return ctes


def _sql(body: str, extra: list[tuple[str, str]] | None = None, **kw) -> str:
    return with_fixtures(["f_mask"], body, _base_ctes(**kw) + (extra or []))


# ------------------------------------------------------------------ queries


@register(
    "coverage_fraction",
    _sql("SELECT strain, chrom, start_bin, end_bin, coverage, mean_cov_genome, fraction_cov FROM c1"),
    "D",
)
def q_coverage_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.coverage_fraction(_mask(spark, sf_dir)).select(
        "strain", "chrom", "start_bin", "end_bin", "coverage", "mean_cov_genome", "fraction_cov"
    )


@register(
    "classify_bins",
    _sql(
        "SELECT strain, chrom, start_bin, end_bin, is_count, is_lowcov, "
        "CASE WHEN is_count OR is_lowcov THEN 'Divergent' ELSE 'Pass' END AS div_class FROM c1"
    ),
    "D",
)
def q_classify_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.classify_bins(D.coverage_fraction(_mask(spark, sf_dir))).select(
        "strain", "chrom", "start_bin", "end_bin", "is_count", "is_lowcov", "div_class"
    )


@register(
    "two_flank_rescue",
    _sql("SELECT strain, chrom, start_bin, div_id, CASE WHEN is_div THEN 'Divergent' ELSE 'Pass' END AS div_class FROM b0"),
    "D",
)
def q_two_flank(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = D.two_flank_rescue(D.classify_bins(D.coverage_fraction(_mask(spark, sf_dir))))
    return df.select("strain", "chrom", "start_bin", "div_id", "div_class")


def _first_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = D.two_flank_rescue(D.classify_bins(D.coverage_fraction(_mask(spark, sf_dir))))
    return D.cluster_bins(flagged.select(*D._BIN_COLS))


@register(
    "cluster_bins",
    _sql("SELECT strain, chrom, start_bin, cl AS cluster, cluster_start, cluster_size, cluster_end FROM k"),
    "D",
)
def q_cluster_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_clusters(spark, sf_dir).select(
        "strain", "chrom", "start_bin", "cluster", "cluster_start", "cluster_size", "cluster_end"
    )


@register(
    "cluster_gaps",
    _sql(
        "SELECT strain, chrom, cluster_start, cluster_size, cluster_end, gap_size, "
        "CASE WHEN joined THEN 'join' END AS gap_join, extended_cluster_end, "
        "MIN(cluster_start) OVER (PARTITION BY strain, chrom, extended_cluster_end) AS extended_cluster_start, "
        "extended_cluster_end - MIN(cluster_start) OVER (PARTITION BY strain, chrom, extended_cluster_end) AS extended_cluster_size "
        "FROM (SELECT *, CASE WHEN joined THEN next_end WHEN next_start IS NOT NULL THEN cluster_end END AS extended_cluster_end FROM g)"
    ),
    "D",
)
def q_cluster_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.cluster_gaps(_first_clusters(spark, sf_dir))


@register(
    "fill_gaps",
    _sql("SELECT strain, chrom, start_bin, div_id, CASE WHEN is_div THEN 'Divergent' ELSE 'Pass' END AS div_class FROM b1"),
    "D",
)
def q_fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.fill_gaps(_first_clusters(spark, sf_dir)).select("strain", "chrom", "start_bin", "div_id", "div_class")


@register(
    "recluster",
    _sql("SELECT strain, chrom, start_bin, cl AS cluster, cluster_start, cluster_size, cluster_end FROM r"),
    "D",
)
def q_recluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.gap_joined_clusters(_mask(spark, sf_dir)).select(
        "strain", "chrom", "start_bin", "cluster", "cluster_start", "cluster_size", "cluster_end"
    )


_FREQ_COLS = ["strain", "chrom", "start_bin", "end_bin", "cluster_start", "cluster_end", "freq", "mwf", "freq_bin", "flag_del"]


@register("divergent_frequency", _sql(f"SELECT {', '.join(_FREQ_COLS)} FROM fq2"), "D")
def q_divergent_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.divergent_bins(_mask(spark, sf_dir), keep_deletions=True).select(*_FREQ_COLS)


@register(
    "divergent_frequency_classes",
    _sql(f"SELECT {', '.join(_FREQ_COLS)} FROM fq2", rare=0.20, intermediate=0.28),
    "D",
)
def q_divergent_frequency_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 with thresholds (0.20, 0.28) so that all three classes occur with 25 strains."""
    return D.divergent_bins(_mask(spark, sf_dir), rare=0.20, intermediate=0.28, keep_deletions=True).select(*_FREQ_COLS)


_FINAL_COLS = [
    "strain", "chrom", "start_bin", "end_bin", "div_id", "cluster_start", "cluster_size",
    "cluster_end", "freq", "mwf", "freq_bin", "is_count",
]


@register("drop_deletions", _sql(f"SELECT {', '.join(_FINAL_COLS)} FROM fin"), "D")
def q_drop_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.divergent_bins(_mask(spark, sf_dir)).select(*_FINAL_COLS)


@register(
    "strain_regions",
    _sql(
        "SELECT chrom, cluster_start AS start_pos, cluster_end AS end_pos, strain, "
        "ROW_NUMBER() OVER (PARTITION BY strain ORDER BY chrom, cluster_start) AS bed_line FROM reg"
    ),
    "D",
)
def q_strain_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.region_bed(D.divergent_regions(_mask(spark, sf_dir)))


@register("divergent_regions", _sql("SELECT * FROM reg"), "D")
def q_divergent_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D17 flagship: D1 -> D10 end to end."""
    return D.divergent_regions(_mask(spark, sf_dir))


@register(
    "total_divergent_size",
    _sql(
        "SELECT freq_bin, COUNT(*) / 1e3 AS size_kb FROM (SELECT DISTINCT chrom, start_bin, end_bin, mwf, freq_bin FROM fin) GROUP BY freq_bin "
        "UNION ALL SELECT 'All' AS freq_bin, COUNT(*) / 1e3 AS size_kb FROM (SELECT DISTINCT chrom, start_bin, end_bin FROM fin)"
    ),
    "D",
)
def q_total_divergent_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.total_divergent_size(D.divergent_bins(_mask(spark, sf_dir)))


_STATS_CTES = [
    (
        "st",
        "SELECT c1.strain, c1.var_count, c1.fraction_cov, CASE WHEN f.strain IS NULL THEN 'Pass' ELSE 'Divergent' END AS div_class "
        "FROM c1 LEFT JOIN fin f ON f.strain = c1.strain AND f.chrom = c1.chrom AND f.start_bin = c1.start_bin",
    ),
    ("ps", "SELECT strain, AVG(var_count) AS mean_count, AVG(fraction_cov) AS mean_cov FROM st GROUP BY strain"),
    (
        "psd",
        "SELECT strain, AVG(var_count) AS mean_count, AVG(fraction_cov) AS mean_cov FROM st WHERE div_class = 'Divergent' GROUP BY strain",
    ),
]


@register(
    "divergence_stats",
    _sql(
        """
        SELECT scope, strain, div_class, ROUND(mean_count, 6) AS mean_count, ROUND(mean_cov, 6) AS mean_cov FROM (
          SELECT 'class' AS scope, CAST(NULL AS VARCHAR) AS strain, div_class, AVG(var_count) AS mean_count, AVG(fraction_cov) AS mean_cov FROM st GROUP BY div_class
          UNION ALL SELECT 'strain', strain, CAST(NULL AS VARCHAR), mean_count, mean_cov FROM ps
          UNION ALL SELECT 'strain_divergent', strain, 'Divergent', mean_count, mean_cov FROM psd
          UNION ALL SELECT 'grand', NULL, NULL, AVG(mean_count), AVG(mean_cov) FROM ps
          UNION ALL SELECT 'grand_divergent', NULL, 'Divergent', AVG(mean_count), AVG(mean_cov) FROM psd)
        """,
        extra=_STATS_CTES,
    ),
    "D",
)
def q_divergence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = D.divergence_stats(_mask(spark, sf_dir))
    return df.select("scope", "strain", "div_class", F.round("mean_count", 6).alias("mean_count"), F.round("mean_cov", 6).alias("mean_cov"))


@register("strain_size", _sql("SELECT strain, COUNT(*) / 1e3 AS size_kb FROM fin GROUP BY strain"), "D")
def q_strain_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.strain_size(D.divergent_bins(_mask(spark, sf_dir)))


_D14 = (
    "SELECT DISTINCT freq_bin AS class, chrom, start_bin, end_bin FROM fin "
    "UNION SELECT DISTINCT 'All' AS class, chrom, start_bin, end_bin FROM fin"
)


@register("bins_by_class", _sql(_D14), "D")
def q_bins_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.bins_by_class(D.divergent_bins(_mask(spark, sf_dir)))


@register(
    "population_regions",
    _sql(
        f"SELECT class, chrom, MIN(start_bin) AS start, MAX(end_bin) AS stop FROM ("
        f"SELECT *, start_bin - 1000 * ROW_NUMBER() OVER (PARTITION BY class, chrom ORDER BY start_bin) AS isl FROM ({_D14})) "
        f"GROUP BY class, chrom, isl"
    ),
    "D",
)
def q_population_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.population_regions(D.divergent_bins(_mask(spark, sf_dir))).withColumnRenamed("end", "stop")


@register(
    "strain_order",
    _sql(
        "SELECT s.chrom, s.start, s.stop, s.strain, s.size, t.total, t.strain_rank FROM "
        "(SELECT chrom, cluster_start AS start, cluster_end AS stop, strain, cluster_end - cluster_start AS size FROM reg) s JOIN "
        "(SELECT strain, total, ROW_NUMBER() OVER (ORDER BY total DESC, strain) AS strain_rank FROM "
        "(SELECT strain, CAST(SUM(cluster_end - cluster_start) AS BIGINT) AS total FROM reg GROUP BY strain)) t ON s.strain = t.strain"
    ),
    "D",
)
def q_strain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.strain_order(D.divergent_regions(_mask(spark, sf_dir)))
