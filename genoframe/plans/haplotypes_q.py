"""Haplotype and sweep queries (E3-E22) over the ``f_seg`` pair-segment fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import haplotypes as H
from ..session import stored
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register

# ------------------------------------------------------------------ oracle SQL
# Intervals by LEAD over distinct breakpoints, edges by plain containment,
# components by a recursive label propagation (smallest label wins).
_E = [
    ("bp", "SELECT chrom, start_pos AS bp FROM f_seg UNION SELECT chrom, stop_pos FROM f_seg"),
    ("iv0", "SELECT chrom, bp AS start, LEAD(bp) OVER (PARTITION BY chrom ORDER BY bp) AS stop FROM bp"),
    ("ivs", "SELECT chrom, start, stop, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY start) AS rank FROM iv0 WHERE stop IS NOT NULL"),
    (
        "edges",
        "SELECT i.chrom, i.start, i.stop, s.strain1, s.strain2 FROM ivs i JOIN f_seg s "
        "ON s.chrom = i.chrom AND s.start_pos <= i.start AND s.stop_pos >= i.stop",
    ),
    ("strains", "SELECT strain1 AS strain FROM f_seg UNION SELECT strain2 FROM f_seg"),
    ("e2", "SELECT chrom, start, strain1 AS a, strain2 AS b FROM edges UNION SELECT chrom, start, strain2, strain1 FROM edges"),
    (
        "lab(chrom, start, s, l)",
        "SELECT chrom, start, a, a FROM e2 UNION SELECT lab.chrom, lab.start, e2.b, lab.l FROM lab JOIN e2 "
        "ON e2.chrom = lab.chrom AND e2.start = lab.start AND e2.a = lab.s WHERE lab.l < e2.b",
    ),
    ("comp", "SELECT chrom, start, s AS strain, MIN(l) AS component FROM lab GROUP BY chrom, start, s"),
    (
        "grid",
        "SELECT i.chrom, i.start, i.stop, st.strain, COALESCE(c.component, st.strain) AS component FROM ivs i CROSS JOIN strains st "
        "LEFT JOIN comp c ON c.chrom = i.chrom AND c.start = i.start AND c.strain = st.strain",
    ),
    ("nst", "SELECT COUNT(*) AS n FROM strains"),
    ("gs", "SELECT *, COUNT(*) OVER (PARTITION BY chrom, start, component) AS csize FROM grid"),
    (
        "nos",
        "SELECT chrom, start, stop, strain, CASE WHEN csize > 1 THEN component END AS component, "
        "CASE WHEN csize > 1 THEN csize END AS csz FROM gs",
    ),
    (
        "sim",
        "SELECT strain, CAST(SUM(CASE WHEN component IS NOT NULL THEN (stop - start) * csz ELSE 0 END) AS BIGINT) AS similarity FROM nos GROUP BY strain",
    ),
    ("rk", "SELECT strain, similarity, ROW_NUMBER() OVER (ORDER BY similarity DESC, strain) AS strain_rank FROM sim"),
    (
        "named",
        "SELECT n.chrom, n.start, n.stop, n.strain, r.strain_rank, CASE WHEN n.component IS NOT NULL THEN "
        "FIRST_VALUE(n.strain) OVER (PARTITION BY n.chrom, n.start, n.component ORDER BY r.strain_rank) END AS haplotype "
        "FROM nos n JOIN rk r ON r.strain = n.strain",
    ),
    (
        "melt",
        "SELECT nm.chrom, nm.start, nm.stop, nm.strain AS isotype, nm.haplotype AS value, nm.strain_rank AS plotpoint, "
        "CAST(0.9 AS DOUBLE) + CAST(vr.strain_rank % 2 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS sat, vr.strain_rank AS cvalue "
        "FROM named nm LEFT JOIN rk vr ON vr.strain = nm.haplotype",
    ),
    (
        "chg",
        "SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY chrom, isotype ORDER BY start, stop) = 1 THEN 1 "
        "WHEN LAG(value) OVER (PARTITION BY chrom, isotype ORDER BY start, stop) IS NOT DISTINCT FROM value THEN 0 ELSE 1 END AS c FROM melt",
    ),
    (
        "seg0",
        "SELECT *, CAST(SUM(c) OVER (PARTITION BY chrom, isotype ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM chg",
    ),
    (
        "runs",
        "SELECT chrom, MIN(start) AS start, MAX(stop) AS stop, value AS haplotype, isotype, plotpoint, sat, segment, cvalue, "
        "MAX(stop) - MIN(start) AS hap_length FROM seg0 WHERE value IS NOT NULL GROUP BY chrom, isotype, segment, value, plotpoint, sat, cvalue",
    ),
    ("ph", "SELECT chrom, haplotype, CAST(SUM(hap_length) AS BIGINT) AS chrom_haplotype_sum FROM runs GROUP BY chrom, haplotype"),
    ("pcm", "SELECT chrom, MAX(chrom_haplotype_sum) AS mx FROM ph GROUP BY chrom"),
    (
        "pcn",
        "SELECT ph.chrom, MIN(ph.haplotype) AS swept_haplotype_name FROM ph JOIN pcm ON pcm.chrom = ph.chrom "
        "WHERE ph.chrom_haplotype_sum = pcm.mx GROUP BY ph.chrom",
    ),
    ("iso", "SELECT chrom, COUNT(DISTINCT isotype) AS isotypes_w_haplotype FROM runs GROUP BY chrom"),
    (
        "sw0",
        "SELECT r.*, ph.chrom_haplotype_sum, ph.chrom_haplotype_sum = pcm.mx AS swept_haplotype, pcn.swept_haplotype_name, iso.isotypes_w_haplotype "
        "FROM runs r JOIN ph ON ph.chrom = r.chrom AND ph.haplotype = r.haplotype JOIN pcm ON pcm.chrom = r.chrom "
        "JOIN pcn ON pcn.chrom = r.chrom JOIN iso ON iso.chrom = r.chrom",
    ),
    (
        "sw",
        "SELECT *, BOOL_OR(haplotype = swept_haplotype_name) OVER (PARTITION BY chrom, isotype) AS isotype_has_swept_haplotype FROM sw0",
    ),
    (
        "hi",
        "SELECT chrom, haplotype, isotype, SUM(CASE WHEN swept_haplotype THEN hap_length ELSE 0 END) AS l FROM sw GROUP BY 1, 2, 3",
    ),
    ("pi", "SELECT chrom, isotype, CAST(MAX(l) AS BIGINT) AS isotype_swept_haplotype_length FROM hi GROUP BY 1, 2"),
    ("pm", "SELECT chrom, MAX(isotype_swept_haplotype_length) AS max_swept_haplotype_length FROM pi GROUP BY 1"),
    (
        "m1",
        "SELECT sw.*, pi.isotype_swept_haplotype_length, pm.max_swept_haplotype_length, "
        "pi.isotype_swept_haplotype_length / pm.max_swept_haplotype_length AS max_haplotype_shared "
        "FROM sw JOIN pi ON pi.chrom = sw.chrom AND pi.isotype = sw.isotype JOIN pm ON pm.chrom = sw.chrom",
    ),
    (
        "m2",
        "SELECT *, CASE WHEN hap_length > 1000000 AND max_haplotype_shared > 0.03 AND swept_haplotype THEN hap_length ELSE 0 END AS filtered_swept_haplotype_len FROM m1",
    ),
    (
        "m3",
        "SELECT *, CAST(SUM(filtered_swept_haplotype_len) OVER (PARTITION BY chrom, isotype) AS BIGINT) AS filtered_sweep_len FROM m2",
    ),
    (
        "plot",
        "SELECT * EXCLUDE (swept_haplotype), filtered_sweep_len / max_swept_haplotype_length AS filtered_sweep_ratio, "
        "filtered_sweep_len / max_swept_haplotype_length > 0.03 AS is_swept, "
        "CASE WHEN NOT (filtered_sweep_len / max_swept_haplotype_length > 0.03) THEN FALSE ELSE swept_haplotype END AS swept_haplotype FROM m3",
    ),
]


def _sql(body: str) -> str:
    return with_fixtures(["f_seg"], body, _E, recursive=True)


def _seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_seg")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_components(_seg(spark, sf_dir))


def _ranked(spark: SparkSession, sf_dir: str):
    nos = H.drop_singleton_haplotypes(_grid(spark, sf_dir))
    return nos, H.sharing_rank(nos)


def _melted(spark: SparkSession, sf_dir: str) -> DataFrame:
    nos, rk = _ranked(spark, sf_dir)
    return H.melt_haplotypes(H.name_haplotypes(nos, rk), rk)


def _plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.plot_table(_seg(spark, sf_dir))


# ------------------------------------------------------------------ queries


@register("breakpoint_intervals", _sql("SELECT chrom, rank, start, stop FROM ivs"), "E")
def q_breakpoint_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.breakpoint_intervals(_seg(spark, sf_dir))


@register("segment_interval_join", _sql("SELECT chrom, start, stop, strain1, strain2 FROM edges"), "E")
def q_segment_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.segment_interval_join(_seg(spark, sf_dir)).drop("rank")


@register("haplotype_components", _sql("SELECT chrom, start, stop, strain, component FROM grid"), "E")
def q_haplotype_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("chrom", "start", "stop", "strain", "component")


@register(
    "haplotype_frequencies",
    _sql("SELECT chrom, start, stop, component, COUNT(*) / (SELECT n FROM nst) AS frequency FROM grid GROUP BY chrom, start, stop, component"),
    "E",
)
def q_haplotype_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_frequencies(_grid(spark, sf_dir))


@register(
    "haplotype_homozygosity",
    _sql(
        "SELECT chrom, start, stop, ROUND(SUM(f * f), 6) AS hh FROM (SELECT chrom, start, stop, COUNT(*) / (SELECT n FROM nst) AS f "
        "FROM grid GROUP BY chrom, start, stop, component) GROUP BY chrom, start, stop"
    ),
    "E",
)
def q_haplotype_homozygosity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_homozygosity(_grid(spark, sf_dir)).withColumn("hh", F.round("hh", 6))


_STRAINS = [f"S{k}" for k in range(25)]  # the fixture's strain names, one per nation


@register(
    "membership_matrix",
    _sql(
        "SELECT chrom, start, stop, "
        + ", ".join(f"MAX(CASE WHEN strain = '{s}' THEN component END) AS {s}" for s in _STRAINS)
        + " FROM grid GROUP BY chrom, start, stop"
    ),
    "E",
)
def q_membership_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.membership_matrix(_grid(spark, sf_dir))


@register("drop_singleton_haplotypes", _sql("SELECT chrom, start, stop, strain, component FROM nos"), "E")
def q_drop_singleton_haplotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.drop_singleton_haplotypes(_grid(spark, sf_dir)).select("chrom", "start", "stop", "strain", "component")


@register("sharing_rank", _sql("SELECT strain, similarity, strain_rank FROM rk"), "E")
def q_sharing_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)[1]


@register("name_haplotypes", _sql("SELECT chrom, start, stop, strain, haplotype FROM named"), "E")
def q_name_haplotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nos, rk = _ranked(spark, sf_dir)
    return H.name_haplotypes(nos, rk).select("chrom", "start", "stop", "strain", "haplotype")


@register("melt_haplotypes", _sql("SELECT chrom, start, stop, isotype, value, plotpoint, sat FROM melt"), "E")
def q_melt_haplotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _melted(spark, sf_dir).select("chrom", "start", "stop", "isotype", "value", "plotpoint", "sat")


@register("haplotype_counts", _sql("SELECT chrom, start, stop, value, COUNT(*) AS n FROM melt GROUP BY chrom, start, stop, value"), "E")
def q_haplotype_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_counts(_melted(spark, sf_dir))


@register("condense_runs", _sql("SELECT * FROM runs"), "E")
def q_condense_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.condense_runs(_melted(spark, sf_dir))


_SWEPT_COLS = [
    "chrom", "start", "stop", "haplotype", "isotype", "chrom_haplotype_sum", "swept_haplotype",
    "swept_haplotype_name", "isotypes_w_haplotype", "isotype_has_swept_haplotype",
]


@register("swept_haplotype", _sql(f"SELECT {', '.join(_SWEPT_COLS)} FROM sw"), "E")
def q_swept_haplotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.swept_haplotype(H.condense_runs(_melted(spark, sf_dir))).select(*_SWEPT_COLS)


_PLOT_COLS = [
    "chrom", "start", "stop", "haplotype", "isotype", "plotpoint", "segment", "cvalue", "hap_length",
    "swept_haplotype", "isotype_swept_haplotype_length", "max_swept_haplotype_length", "max_haplotype_shared",
    "filtered_swept_haplotype_len", "filtered_sweep_len", "filtered_sweep_ratio", "is_swept",
]


@register("sweep_metrics", _sql(f"SELECT {', '.join(_PLOT_COLS)} FROM plot"), "E")
def q_sweep_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plot(spark, sf_dir).select(*_PLOT_COLS)


@register("haplotype_output", _sql("SELECT chrom, start, stop, haplotype, isotype, plotpoint, segment, cvalue FROM plot"), "E")
def q_haplotype_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_output(_plot(spark, sf_dir))


_CONTIGS = ["I", "II", "III", "IV", "V", "X"]


_SWEEP_SUMMARY = (
    "SELECT isotype, "
    + ", ".join(f'MAX(CASE WHEN chrom = \'{c}\' THEN filtered_sweep_ratio END) AS "{c}"' for c in _CONTIGS)
    + " FROM (SELECT DISTINCT chrom, isotype, filtered_sweep_ratio FROM plot) GROUP BY isotype"
)


@register(
    "sweep_summary",
    _sql(_SWEEP_SUMMARY),
    "E",
)
def q_sweep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.sweep_summary(_plot(spark, sf_dir))


@register(
    "haplotype_share",
    _sql(
        "SELECT isotype, "
        + ", ".join(f"MAX(CASE WHEN chrom = '{c}' THEN max_haplotype_shared END) AS {c}_hapshare" for c in _CONTIGS)
        + " FROM (SELECT DISTINCT chrom, isotype, max_haplotype_shared, COALESCE(is_swept, FALSE) AS is_swept FROM plot) GROUP BY isotype"
    ),
    "E",
)
def q_haplotype_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_share(_plot(spark, sf_dir))


@register(
    "haplotype_length_histogram",
    _sql(
        "SELECT bin, ROUND((bin - 0.5) * (6.0 / 29), 6) AS xmin_log10, ROUND((bin + 0.5) * (6.0 / 29), 6) AS xmax_log10, COUNT(*) AS count FROM "
        "(SELECT CAST(GREATEST(CEIL(log10(CAST(hap_length AS DOUBLE)) / (6.0 / 29) - 0.5), 0) AS BIGINT) AS bin FROM plot "
        "WHERE hap_length >= 1 AND hap_length <= 1000000) GROUP BY bin"
    ),
    "E",
)
def q_haplotype_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_length_histogram(_plot(spark, sf_dir))


@register(
    "haplotype_plot_rects",
    _sql(
        "SELECT DISTINCT chrom, start / 1e6 AS xmin, stop / 1e6 AS xmax, CAST(plotpoint AS DOUBLE) - 0.5 AS ymin, CAST(plotpoint AS DOUBLE) + 0.5 AS ymax, "
        "haplotype AS fill, swept_haplotype AS swept FROM plot"
    ),
    "E",
)
def q_haplotype_plot_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_plot_rects(_plot(spark, sf_dir))


@register("haplotype_plot_labels", _sql("SELECT DISTINCT plotpoint, isotype FROM plot"), "E")
def q_haplotype_plot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.haplotype_plot_labels(_plot(spark, sf_dir))


# ------------------------------------------------------------------ E1 / E2: IBD from genotypes

from ..operators import ibd as IBD  # noqa: E402

_IBD = [
    (
        "calls",
        "SELECT site_id, chrom, pos, strain, CAST(split_part(gt, '/', 1) <> '0' AS INT) + CAST(split_part(gt, '/', 2) <> '0' AS INT) AS d "
        "FROM f_geno WHERE alt NOT LIKE '%,%' AND gt NOT LIKE '%.%'",
    ),
    ("mk", "SELECT site_id, chrom, pos, CAST(SUM(d) AS BIGINT) AS ac, 2 * COUNT(*) AS an FROM calls GROUP BY site_id, chrom, pos"),
    ("mk2", "SELECT site_id, chrom, pos, ac, an, ac / an AS p, LEAST(ac, an - ac) / an AS maf FROM mk WHERE LEAST(ac, an - ac) >= 4"),
    (
        "pr",
        "SELECT a.chrom, a.pos, a.strain AS s1, b.strain AS s2, a.d AS g1, b.d AS g2, m.p, 1 - m.p AS q, "
        "LEAST(CAST(0.25 AS DOUBLE) * m.maf, CAST(0.001 AS DOUBLE)) AS eps "
        "FROM calls a JOIN calls b ON a.site_id = b.site_id AND a.strain < b.strain JOIN mk2 m ON m.site_id = a.site_id",
    ),
    (
        "pl",
        "SELECT *, CASE g1 * 3 + g2 WHEN 0 THEN q * q * q WHEN 1 THEN q * q * p WHEN 3 THEN q * q * p WHEN 4 THEN p * q "
        "WHEN 5 THEN p * p * q WHEN 7 THEN p * p * q WHEN 8 THEN p * p * p ELSE CAST(0 AS DOUBLE) END AS pibd, "
        "(CASE g1 WHEN 0 THEN q * q WHEN 1 THEN 2 * p * q ELSE p * p END) * (CASE g2 WHEN 0 THEN q * q WHEN 1 THEN 2 * p * q ELSE p * p END) AS pnull FROM pr",
    ),
    ("ls", "SELECT chrom, pos, s1, s2, CAST(ROUND(log10(((1 - eps) * pibd + eps * pnull) / pnull) * 1000000) AS BIGINT) AS l FROM pl"),
    (
        "cs",
        "SELECT *, SUM(l) OVER (PARTITION BY s1, s2, chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM ls",
    ),
    (
        "cm",
        "SELECT *, LEAST(0, MIN(s) OVER (PARTITION BY s1, s2, chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS m FROM cs",
    ),
    ("cf", "SELECT *, m < COALESCE(LAG(m) OVER (PARTITION BY s1, s2, chrom ORDER BY pos), 0) AS fall, s - m AS dd FROM cm"),
    (
        "ce",
        "SELECT *, SUM(CAST(fall AS INT)) OVER (PARTITION BY s1, s2, chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS exc FROM cf",
    ),
    ("cx", "SELECT *, MAX(dd) OVER (PARTITION BY s1, s2, chrom, exc) AS peak FROM ce"),
]


@register(
    "ibd_markers",
    with_fixtures(["f_geno"], "SELECT site_id, chrom, pos, ac, an, p, maf FROM mk2", _IBD[:3]),
    "E",
)
def q_ibd_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IBD.ibd_markers(fixture(spark, sf_dir, "f_geno")).select("site_id", "chrom", "pos", "ac", "an", "p", "maf")


_IBD_SEGMENTS = (
    "SELECT s1 AS strain1, 1 AS ind1, s2 AS strain2, 1 AS ind2, chrom, MIN(pos) FILTER (WHERE NOT fall) AS start_pos, "
    "MIN(pos) FILTER (WHERE dd = peak) AS stop_pos, CAST(MAX(peak) AS DOUBLE) / 1000000 AS lod FROM cx "
    "GROUP BY s1, s2, chrom, exc HAVING MAX(peak) >= 3000000"
)


@register(
    "ibd_segments",
    with_fixtures(
        ["f_geno"],
        _IBD_SEGMENTS,
        _IBD,
    ),
    "E",
)
def q_ibd_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IBD.ibd_segments(fixture(spark, sf_dir, "f_geno"))


_MARKER_LD = [
    ("mkr", "SELECT site_id, chrom, pos, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY pos, site_id) AS rk FROM mk2"),
    (
        "md",
        "SELECT m.chrom, m.rk, g.strain, CAST(CASE WHEN g.gt NOT LIKE '%.%' THEN CAST(split_part(g.gt, '/', 1) <> '0' AS INT) "
        "+ CAST(split_part(g.gt, '/', 2) <> '0' AS INT) END AS DOUBLE) AS d FROM f_geno g JOIN mkr m ON m.site_id = g.site_id",
    ),
    (
        "mr",
        "SELECT chrom, a, b FROM (SELECT x.chrom, x.rk AS a, y.rk AS b, COUNT(*) * SUM(x.d * x.d) - SUM(x.d) * SUM(x.d) AS vx, "
        "COUNT(*) * SUM(y.d * y.d) - SUM(y.d) * SUM(y.d) AS vy, COUNT(*) * SUM(x.d * y.d) - SUM(x.d) * SUM(y.d) AS cv FROM md x JOIN md y "
        "ON y.chrom = x.chrom AND y.strain = x.strain AND y.rk > x.rk AND y.rk < x.rk + 1500 WHERE x.d IS NOT NULL AND y.d IS NOT NULL "
        "GROUP BY x.chrom, x.rk, y.rk) WHERE vx > 0 AND vy > 0 AND (cv * cv) / (vx * vy) > 0.3",
    ),
    ("mn", "SELECT m.chrom, m.rk, COALESCE(n.earlier, CAST([] AS BIGINT[])) AS earlier FROM mkr m "
     "LEFT JOIN (SELECT chrom, b, LIST(a) AS earlier FROM mr GROUP BY chrom, b) n ON n.chrom = m.chrom AND n.b = m.rk"),
    # marker by marker: kept unless linked to an earlier kept one
    (
        "mwalk",
        "SELECT DISTINCT chrom, CAST(0 AS BIGINT) AS rk, CAST([] AS BIGINT[]) AS kept FROM mn UNION ALL "
        "SELECT m.chrom, m.rk, CASE WHEN list_has_any(w.kept, m.earlier) THEN w.kept ELSE list_append(w.kept, m.rk) END "
        "FROM mwalk w JOIN mn m ON m.chrom = w.chrom AND m.rk = w.rk + 1",
    ),
    ("mkept", "SELECT chrom, UNNEST(kept) AS rk FROM (SELECT chrom, ARG_MAX(kept, rk) AS kept FROM mwalk GROUP BY chrom)"),
    ("mf", "SELECT chrom, rk, LEAST(p, 1 - p) AS maf FROM (SELECT chrom, rk, SUM(d) / (2 * COUNT(d)) AS p FROM md GROUP BY chrom, rk)"),
]


@register(
    "ibd_marker_ld_filter",
    with_fixtures(
        ["f_geno"],
        "SELECT m.site_id, m.chrom, m.pos, mf.maf FROM mkept k JOIN mkr m ON m.chrom = k.chrom AND m.rk = k.rk "
        "JOIN mf ON mf.chrom = k.chrom AND mf.rk = k.rk",
        _IBD[:3] + _MARKER_LD,
        recursive=True,
    ),
    "E",
)
def q_ibd_marker_ld_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 (LD part): markers kept by the r^2 <= 0.3 filter over 1500 markers."""
    return IBD.ibd_marker_ld_filter(fixture(spark, sf_dir, "f_geno"))


@register("ibd_segments_filtered", None, "E")
def q_ibd_segments_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 -> E2: segments over the markers that the LD filter keeps; tested
    against E2 on the kept markers."""
    return IBD.ibd_segments(fixture(spark, sf_dir, "f_geno"), r2max=IBD.R2_MAX)


@register(
    "ibd_sweep_summary",
    with_fixtures(["f_geno"], _SWEEP_SUMMARY, _IBD + [("f_seg", _IBD_SEGMENTS)] + _E, recursive=True),
    "E",
)
def q_ibd_sweep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls -> E2 segments -> E3-E19 in one flow."""
    segments = stored(IBD.ibd_segments(fixture(spark, sf_dir, "f_geno")), "ibd-segments")
    return H.sweep_summary(H.plot_table(segments))
