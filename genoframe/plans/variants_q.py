"""Variant-table queries (B1-B23) over ``f_geno`` / ``f_site`` and the small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import variants as V
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register

# ------------------------------------------------------------------ oracle helpers
# Calls are diploid "a/b" in the fixtures: the oracle parses them with
# split_part, independently of the Spark array expressions.
GA = (
    "ga",
    "SELECT g.*, NULLIF(split_part(gt, '/', 1), '.') AS a1, NULLIF(split_part(gt, '/', 2), '.') AS a2 FROM f_geno g",
)
GA2 = (
    "gb",
    "SELECT *, CAST(a1 IS NOT NULL AS INT) + CAST(a2 IS NOT NULL AS INT) AS called, "
    "COALESCE(CAST(a1 <> '0' AS INT), 0) + COALESCE(CAST(a2 <> '0' AS INT), 0) AS nonref FROM ga",
)
SINGLE = [
    ("al", "SELECT chrom, pos, strain, a1 AS allele FROM ga WHERE a1 IS NOT NULL UNION ALL SELECT chrom, pos, strain, a2 FROM ga WHERE a2 IS NOT NULL"),
    ("sg", "SELECT chrom, pos, allele, COUNT(*) AS n, COUNT(DISTINCT strain) AS nst, MAX(strain) AS strain FROM al GROUP BY chrom, pos, allele"),
    (
        "single",
        "SELECT chrom, pos, CASE WHEN n = 1 THEN 'S' ELSE 'D' END AS singleton_type, CAST(allele AS INT) AS allele, strain, "
        "chrom || ':' || CAST(pos AS VARCHAR) AS id FROM sg WHERE n = 1 OR (n = 2 AND nst = 1)",
    ),
]
BIALLELIC_SNP = ("bs", "SELECT * FROM f_site WHERE length(ref) = 1 AND length(alt) = 1")


def _geno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_geno")


def _gsql(body: str, fixtures: list[str] | None = None, ctes: list[tuple[str, str]] | None = None) -> str:
    return with_fixtures(["f_geno"] + (fixtures or []), body, [GA, GA2] + (ctes or []))


GT_COLS = ["site_id", "strain", "gt"]


# ------------------------------------------------------------------ B1-B4


@register("subset_samples", _gsql("SELECT site_id, strain, gt FROM f_geno WHERE strain IN (SELECT strain FROM f_sheet)", ["f_sheet"]), "B")
def q_subset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.subset_samples(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_sheet")).select(*GT_COLS)


_POLY = [
    ("sub", "SELECT * FROM gb WHERE strain IN (SELECT strain FROM f_sheet)"),
    ("st", "SELECT site_id, SUM(nonref) AS ac, SUM(called) AS an FROM sub GROUP BY site_id"),
    ("poly", "SELECT sub.* FROM sub JOIN st ON sub.site_id = st.site_id WHERE st.an > 0 AND st.ac / st.an >= 0.000001 AND st.ac / st.an <= 0.999999"),
]


@register("polymorphic_sites", _gsql("SELECT site_id, strain, gt FROM poly", ["f_sheet"], _POLY), "B")
def q_polymorphic_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = V.subset_samples(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_sheet"))
    return V.polymorphic_sites(sub).select(*GT_COLS)


_COUNTS = [
    (
        "alts",
        "SELECT site_id, chrom, pos, ref, 1 AS alt_index, split_part(alt, ',', 1) AS alt_allele FROM f_site "
        "UNION ALL SELECT site_id, chrom, pos, ref, 2, split_part(alt, ',', 2) FROM f_site WHERE alt LIKE '%,%'",
    ),
    (
        "acs",
        "SELECT site_id, CAST(a AS INT) AS alt_index, COUNT(*) AS ac FROM "
        "(SELECT site_id, a1 AS a FROM ga UNION ALL SELECT site_id, a2 FROM ga) WHERE a IS NOT NULL AND a <> '0' GROUP BY 1, 2",
    ),
    ("ans", "SELECT site_id, CAST(SUM(called) AS BIGINT) AS an, CAST(SUM(CASE WHEN called > 0 THEN 1 ELSE 0 END) AS BIGINT) AS ns FROM gb GROUP BY site_id"),
]


@register(
    "site_counts",
    _gsql(
        "SELECT a.site_id, a.chrom, a.pos, a.ref, CAST(a.alt_index AS INT) AS alt_index, a.alt_allele, COALESCE(c.ac, 0) AS ac, n.an, "
        "CASE WHEN n.an > 0 THEN COALESCE(c.ac, 0) / n.an END AS af, n.ns FROM alts a JOIN ans n ON a.site_id = n.site_id "
        "LEFT JOIN acs c ON c.site_id = a.site_id AND c.alt_index = a.alt_index",
        ["f_site"],
        _COUNTS,
    ),
    "B",
)
def q_site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.site_counts(_geno(spark, sf_dir))


@register(
    "rename_samples",
    _gsql("SELECT g.site_id, COALESCE(r.isotype, g.strain) AS strain, g.gt FROM f_geno g LEFT JOIN f_rename r ON r.ref_strain = g.strain", ["f_rename"]),
    "B",
)
def q_rename_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.rename_samples(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_rename")).select(*GT_COLS)


@register(
    "isotype_variants",
    _gsql(
        "SELECT p.site_id, COALESCE(r.isotype, p.strain) AS strain, p.gt FROM poly p LEFT JOIN f_rename r ON r.ref_strain = p.strain",
        ["f_sheet", "f_rename"],
        _POLY,
    ),
    "B",
)
def q_isotype_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subset_iso_ref_strains: B1 -> B2 -> B4 end to end."""
    df = V.isotype_table(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_sheet"), fixture(spark, sf_dir, "f_rename"))
    return df.select(*GT_COLS)


# ------------------------------------------------------------------ B5-B8, B14


@register(
    "filter_snps",
    with_fixtures(
        ["f_site"],
        "SELECT site_id, chrom, pos, ref, alt FROM f_site WHERE length(ref) = 1 "
        "AND length(alt) - (length(alt) - length(replace(alt, ',', ''))) = (length(alt) - length(replace(alt, ',', ''))) + 1",
    ),
    "B",
)
def q_filter_snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.filter_snps(fixture(spark, sf_dir, "f_site")).select("site_id", "chrom", "pos", "ref", "alt")


@register(
    "snv_site_counts",
    _gsql(
        "SELECT a.site_id, a.chrom, a.pos, a.ref, CAST(a.alt_index AS INT) AS alt_index, a.alt_allele, COALESCE(c.ac, 0) AS ac, n.an, "
        "CASE WHEN n.an > 0 THEN COALESCE(c.ac, 0) / n.an END AS af, n.ns FROM alts a JOIN ans n ON a.site_id = n.site_id "
        "JOIN snv ON snv.site_id = a.site_id LEFT JOIN acs c ON c.site_id = a.site_id AND c.alt_index = a.alt_index",
        ["f_site"],
        _COUNTS
        + [
            ("nr", "SELECT site_id, SUM(nonref) AS ac, SUM(called) AS an FROM gb GROUP BY site_id"),
            (
                "snv",
                "SELECT s.site_id FROM f_site s JOIN nr ON nr.site_id = s.site_id WHERE length(s.ref) = 1 "
                "AND (length(split_part(s.alt, ',', 1)) = 1 OR (s.alt LIKE '%,%' AND length(split_part(s.alt, ',', 2)) = 1)) "
                "AND nr.an > 0 AND nr.ac / nr.an >= 0.000001 AND nr.ac / nr.an <= 0.999999",
            ),
        ],
    ),
    "B",
)
def q_snv_site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SNV flow: B5 (any ALT of one base) -> B2 -> B3."""
    return V.site_counts(V.polymorphic_sites(V.filter_snps(_geno(spark, sf_dir), mode="any")))


@register("genotype_only", _gsql("SELECT site_id, chrom, pos, ref, alt, strain, gt FROM f_geno"), "B")
def q_genotype_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.genotype_only(_geno(spark, sf_dir))


@register(
    "list_samples",
    _gsql(
        "SELECT strain, ROW_NUMBER() OVER (ORDER BY strain) AS sample_idx FROM (SELECT DISTINCT COALESCE(r.isotype, g.strain) AS strain "
        "FROM f_geno g LEFT JOIN f_rename r ON r.ref_strain = g.strain WHERE g.strain IN (SELECT strain FROM f_sheet))",
        ["f_sheet", "f_rename"],
    ),
    "B",
)
def q_list_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = V.subset_samples(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_sheet"))
    return V.list_samples(V.rename_samples(g, fixture(spark, sf_dir, "f_rename")))


@register(
    "filter_regions",
    with_fixtures(
        ["f_site"],
        "SELECT site_id, chrom, pos FROM (SELECT site_id, pos, CASE WHEN pos % 7 = 0 THEN 'MtDNA' ELSE chrom END AS chrom FROM f_site) "
        "WHERE chrom IN ('I', 'II', 'III', 'IV', 'V', 'X')",
    ),
    "B",
)
def q_filter_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 over sites of which some lie on a seventh contig."""
    sites = fixture(spark, sf_dir, "f_site").select("site_id", "chrom", "pos")
    other = F.when(F.col("pos") % 7 == 0, "MtDNA").otherwise(F.col("chrom"))
    return V.filter_regions(sites.withColumn("chrom", other))


@register("biallelic_sites", with_fixtures(["f_site"], "SELECT site_id, chrom, pos, ref, alt FROM f_site WHERE alt NOT LIKE '%,%'"), "B")
def q_biallelic_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.biallelic_sites(fixture(spark, sf_dir, "f_site")).select("site_id", "chrom", "pos", "ref", "alt")


# ------------------------------------------------------------------ B9

_MERGE = [
    ("mg", "SELECT chrom, pos - pos % 60000 AS pos, ref, alt, strain, gt FROM f_geno"),
    ("recs", "SELECT DISTINCT chrom, pos, ref, alt FROM mg"),
    (
        "ra",
        "SELECT chrom, pos, ref, split_part(alt, ',', 1) AS a FROM recs UNION SELECT chrom, pos, ref, split_part(alt, ',', 2) FROM recs WHERE alt LIKE '%,%'",
    ),
    ("ml", "SELECT chrom, pos, ref, list_sort(list_distinct(list(a))) AS alts FROM ra GROUP BY chrom, pos, ref"),
    ("mp", "SELECT *, NULLIF(split_part(gt, '/', 1), '.') AS a1, NULLIF(split_part(gt, '/', 2), '.') AS a2 FROM mg"),
    (
        "gm",
        "SELECT mp.chrom, mp.pos, mp.ref, array_to_string(ml.alts, ',') AS alt, mp.strain, "
        "CASE WHEN a1 IS NULL THEN NULL WHEN a1 = '0' THEN 0 ELSE list_position(ml.alts, split_part(mp.alt, ',', CAST(a1 AS INT))) END AS n1, "
        "CASE WHEN a2 IS NULL THEN NULL WHEN a2 = '0' THEN 0 ELSE list_position(ml.alts, split_part(mp.alt, ',', CAST(a2 AS INT))) END AS n2 "
        "FROM mp JOIN ml ON mp.chrom = ml.chrom AND mp.pos = ml.pos AND mp.ref = ml.ref",
    ),
]


@register(
    "merge_multiallelic",
    with_fixtures(
        ["f_geno"],
        "SELECT chrom, pos, ref, alt, strain, COALESCE(CAST(MAX(n1) AS VARCHAR), '.') || '/' || COALESCE(CAST(MAX(n2) AS VARCHAR), '.') AS gt "
        "FROM gm GROUP BY chrom, pos, ref, alt, strain",
        _MERGE,
    ),
    "B",
)
def q_merge_multiallelic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 on positions collapsed to 60 kb (FIXTURES: positions are distinct otherwise)."""
    g = _geno(spark, sf_dir).withColumn("pos", F.col("pos") - F.col("pos") % 60000)
    return V.merge_multiallelic(g).drop("site_id")


# ------------------------------------------------------------------ B10-B13


@register(
    "target_sites",
    _gsql(
        "SELECT site_id, strain, gt FROM f_geno g WHERE EXISTS (SELECT 1 FROM f_markers m WHERE m.chrom = g.chrom AND m.pos = g.pos)",
        ["f_markers"],
    ),
    "B",
)
def q_target_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.target_sites(_geno(spark, sf_dir), fixture(spark, sf_dir, "f_markers")).select(*GT_COLS)


@register(
    "exclude_sites",
    _gsql("SELECT site_id, strain, gt FROM f_geno WHERE chrom || ':' || CAST(pos AS VARCHAR) NOT IN (SELECT id FROM single)", None, SINGLE),
    "B",
)
def q_exclude_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _geno(spark, sf_dir)
    return V.exclude_sites(g, V.singletons(g)).select(*GT_COLS)


@register(
    "alt_carriers",
    _gsql("SELECT site_id, strain, gt FROM ga WHERE COALESCE(a1 <> '0', FALSE) OR COALESCE(a2 <> '0', FALSE)"),
    "B",
)
def q_alt_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.alt_carriers(_geno(spark, sf_dir)).select(*GT_COLS)


@register(
    "complete_sites",
    _gsql("SELECT site_id, strain, gt FROM f_geno WHERE site_id NOT IN (SELECT site_id FROM ga WHERE a1 IS NULL OR a2 IS NULL)"),
    "B",
)
def q_complete_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.complete_sites(_geno(spark, sf_dir)).select(*GT_COLS)


# ------------------------------------------------------------------ B15-B19


@register(
    "assign_ids",
    with_fixtures(
        ["f_site"],
        "SELECT site_id, id, split_part(id, ':', 1) AS id_chrom, CAST(split_part(id, ':', 2) AS BIGINT) AS id_pos "
        "FROM (SELECT site_id, chrom || ':' || CAST(CASE WHEN pos % 3 = 0 THEN pos + 1 ELSE pos END AS VARCHAR) AS id FROM f_site)",
    ),
    "B",
)
def q_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 over sites of which a third has an id (another one than its own place)."""
    given = F.when(F.col("pos") % 3 == 0, F.concat("chrom", F.lit(":"), (F.col("pos") + 1).cast("string")))
    s = V.assign_ids(fixture(spark, sf_dir, "f_site").select("site_id", "chrom", "pos", given.alias("id")))
    m = V.ids_to_markers(s.select("site_id", "id"))
    return m.withColumnRenamed("chrom", "id_chrom").withColumnRenamed("pos", "id_pos")


@register(
    "ancestor_bed",
    _gsql(
        "SELECT strain, chrom, pos - 1 AS start, pos + length(ref) - 1 AS stop, "
        "CASE WHEN a1 IS NULL THEN '.' WHEN a1 = '0' THEN ref ELSE split_part(alt, ',', CAST(a1 AS INT)) END AS allele FROM ga"
    ),
    "B",
)
def q_ancestor_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ancestor_bed(_geno(spark, sf_dir)).withColumnRenamed("end", "stop")


_ANNOT = (
    "SELECT s.site_id, s.chrom, s.pos, s.ref, s.alt, arg_min(a.cm, a.start_pos) AS cm, COUNT(a.start_pos) AS cm_n "
    "FROM f_site s LEFT JOIN f_annot a ON a.chrom = s.chrom AND s.pos - 1 < a.end_pos AND a.start_pos < s.pos - 1 + length(s.ref) "
    "GROUP BY s.site_id, s.chrom, s.pos, s.ref, s.alt"
)


@register("interval_annotate", with_fixtures(["f_site", "f_annot"], _ANNOT), "B")
def q_interval_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = fixture(spark, sf_dir, "f_site").select("site_id", "chrom", "pos", "ref", "alt")
    return V.interval_annotate(sites, fixture(spark, sf_dir, "f_annot"), "cm")


@register(
    "drop_flagged",
    with_fixtures(
        ["f_site", "f_annot"],
        f"SELECT * FROM (SELECT *, CASE WHEN cm_n = 0 THEN 'none' WHEN pos % 4 = 0 THEN 'repeatMasked' ELSE 'PASS' END AS flag FROM ({_ANNOT})) "
        "WHERE NOT contains(concat_ws('\t', site_id, chrom, pos, ref, alt, COALESCE(CAST(cm AS VARCHAR), ''), cm_n, flag), 'Masked')",
    ),
    "B",
)
def q_drop_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B18 over annotated sites of which some bear a masked flag."""
    sites = fixture(spark, sf_dir, "f_site").select("site_id", "chrom", "pos", "ref", "alt")
    annotated = V.interval_annotate(sites, fixture(spark, sf_dir, "f_annot"), "cm")
    flag = F.when(F.col("cm_n") == 0, "none").when(F.col("pos") % 4 == 0, "repeatMasked").otherwise("PASS")
    return V.drop_flagged(annotated.withColumn("flag", flag))


@register("singletons", _gsql("SELECT * FROM single", None, SINGLE), "B")
def q_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.singletons(_geno(spark, sf_dir))


# ------------------------------------------------------------------ B20-B23


def _snp_geno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.biallelic_sites(V.filter_snps(_geno(spark, sf_dir)))


_LD = [
    BIALLELIC_SNP,
    ("rk", "SELECT site_id, chrom, pos, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY pos, site_id) AS rk FROM bs"),
    (
        "dd",
        "SELECT site_id, strain, CASE WHEN a1 IS NULL OR a2 IS NULL THEN NULL ELSE CAST(a1 <> '0' AS INT) + CAST(a2 <> '0' AS INT) END AS d "
        "FROM ga WHERE site_id IN (SELECT site_id FROM bs)",
    ),
    (
        "pr",
        "SELECT a.chrom, a.site_id AS site1, a.pos AS pos1, b.site_id AS site2, b.pos AS pos2 FROM rk a JOIN rk b "
        "ON a.chrom = b.chrom AND b.rk > a.rk AND b.rk < a.rk + 50",
    ),
    (
        "xy",
        "SELECT pr.*, CAST(d1.d AS DOUBLE) AS x, CAST(d2.d AS DOUBLE) AS y FROM pr JOIN dd d1 ON d1.site_id = pr.site1 "
        "JOIN dd d2 ON d2.site_id = pr.site2 AND d2.strain = d1.strain WHERE d1.d IS NOT NULL AND d2.d IS NOT NULL",
    ),
]


@register(
    "ld_r2",
    _gsql(
        "SELECT chrom, site1, pos1, site2, pos2, ROUND(CASE WHEN vx > 0 AND vy > 0 THEN (cv * cv) / (vx * vy) END, 6) AS r2 FROM ("
        "SELECT chrom, site1, pos1, site2, pos2, COUNT(*) * SUM(x * x) - SUM(x) * SUM(x) AS vx, COUNT(*) * SUM(y * y) - SUM(y) * SUM(y) AS vy, "
        "COUNT(*) * SUM(x * y) - SUM(x) * SUM(y) AS cv FROM xy GROUP BY chrom, site1, pos1, site2, pos2)",
        ["f_site"],
        _LD,
    ),
    "B",
)
def q_ld_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = V.ld_r2(_snp_geno(spark, sf_dir))
    return df.withColumn("r2", F.round("r2", 6))


_PRUNE = _LD + [
    (
        "r2",
        "SELECT chrom, site1, site2, (cv * cv) / (vx * vy) AS r2 FROM (SELECT chrom, site1, site2, COUNT(*) * SUM(x * x) - SUM(x) * SUM(x) AS vx, "
        "COUNT(*) * SUM(y * y) - SUM(y) * SUM(y) AS vy, COUNT(*) * SUM(x * y) - SUM(x) * SUM(y) AS cv FROM xy GROUP BY chrom, site1, site2) "
        "WHERE vx > 0 AND vy > 0",
    ),
    (
        "mf",
        "SELECT site_id, CASE WHEN called > 0 THEN LEAST(alt / called, 1 - alt / called) ELSE CAST(0 AS DOUBLE) END AS maf FROM "
        "(SELECT site_id, CAST(COALESCE(SUM(d), 0) AS DOUBLE) AS alt, CAST(2 * COUNT(d) AS DOUBLE) AS called FROM dd GROUP BY site_id)",
    ),
    (
        "ed0",
        "SELECT r2.chrom, a.rk AS a, b.rk AS b, CASE WHEN ma.maf >= mb.maf THEN b.rk ELSE a.rk END AS victim, "
        "CAST(CEIL(GREATEST(b.rk - 50, 0) / 10) AS BIGINT) * 10 + 1 AS w FROM r2 JOIN rk a ON a.site_id = r2.site1 "
        "JOIN rk b ON b.site_id = r2.site2 JOIN mf ma ON ma.site_id = r2.site1 JOIN mf mb ON mb.site_id = r2.site2 WHERE r2.r2 > 0.8",
    ),
    # every edge in the order of the windows; an edge with both ends kept removes its victim
    ("ed", "SELECT chrom, a, b, victim, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY w, a, b) AS n FROM ed0 WHERE w <= a"),
    (
        "walk",
        "SELECT DISTINCT chrom, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS gone FROM ed UNION ALL "
        "SELECT e.chrom, e.n, CASE WHEN list_contains(w.gone, e.a) OR list_contains(w.gone, e.b) THEN w.gone ELSE list_append(w.gone, e.victim) END "
        "FROM walk w JOIN ed e ON e.chrom = w.chrom AND e.n = w.n + 1",
    ),
    ("rm", "SELECT chrom, UNNEST(gone) AS rk FROM (SELECT chrom, ARG_MAX(gone, n) AS gone FROM walk GROUP BY chrom)"),
]


@register(
    "ld_prune",
    with_fixtures(
        ["f_geno", "f_site"],
        "SELECT rk.site_id, rk.chrom, rk.pos, mf.maf FROM rk JOIN mf ON mf.site_id = rk.site_id "
        "WHERE NOT EXISTS (SELECT 1 FROM rm WHERE rm.chrom = rk.chrom AND rm.rk = rk.rk)",
        [GA, GA2] + _PRUNE,
        recursive=True,
    ),
    "B",
)
def q_ld_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B21 at r^2 threshold 0.8 (the reference's debug setting); kept sites."""
    return V.ld_prune(_snp_geno(spark, sf_dir), 0.8)


@register(
    "recode_dosage",
    _gsql(
        "SELECT site_id, strain, "
        "CASE WHEN a1 IS NULL THEN '0' WHEN (a1 = '1') = alt_minor THEN '1' ELSE '2' END || ' ' || "
        "CASE WHEN a2 IS NULL THEN '0' WHEN (a2 = '1') = alt_minor THEN '1' ELSE '2' END AS code12, "
        "CASE WHEN a1 IS NULL OR a2 IS NULL THEN NULL ELSE CAST(a1 <> '0' AS INT) + CAST(a2 <> '0' AS INT) END AS dosage FROM "
        "(SELECT ga.*, SUM(COALESCE(CAST(a1 = '1' AS INT), 0) + COALESCE(CAST(a2 = '1' AS INT), 0)) OVER (PARTITION BY site_id) <= "
        "SUM(COALESCE(CAST(a1 = '0' AS INT), 0) + COALESCE(CAST(a2 = '0' AS INT), 0)) OVER (PARTITION BY site_id) AS alt_minor "
        "FROM ga WHERE site_id IN (SELECT site_id FROM bs))",
        ["f_site"],
        [BIALLELIC_SNP],
    ),
    "B",
)
def q_recode_dosage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.recode_dosage(_snp_geno(spark, sf_dir))


@register(
    "marker_table",
    with_fixtures(
        ["f_site"],
        "SELECT CASE chrom WHEN 'I' THEN '1' WHEN 'II' THEN '2' WHEN 'III' THEN '3' WHEN 'IV' THEN '4' WHEN 'V' THEN '5' ELSE chrom END AS chrom, "
        "chrom || ':' || CAST(pos AS VARCHAR) AS id, 0 AS cm, pos AS bp, alt AS a1, ref AS a2 FROM bs",
        [BIALLELIC_SNP],
    ),
    "B",
)
def q_marker_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.marker_table(V.biallelic_sites(V.filter_snps(fixture(spark, sf_dir, "f_site"))))


@register(
    "individual_table",
    _gsql("SELECT DISTINCT 1 AS family, strain AS id, 0 AS father, 0 AS mother, 0 AS sex, 1 AS status FROM f_geno"),
    "B",
)
def q_individual_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.individual_table(_geno(spark, sf_dir).select("strain").dropDuplicates())
