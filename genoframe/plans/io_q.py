"""Source / sink queries (A1-A3, A5-A10): round trips through the file formats.

Each query writes a table derived from the driver's data into a fresh folder
under the shared checkpoint folder, reads it back with the reader under test,
and is checked against the original view in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import divergent as D
from ..operators import variants as V
from ..sources import io
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register
from .divergent_q import _sql as divergent_sql
from .variants_q import _LD, _gsql


@register("vcf_ingest", with_fixtures(["f_geno"], "SELECT chrom, pos, ref, alt, strain, gt FROM f_geno"), "A")
def q_vcf_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "vcf")
    io.write_vcf(fixture(spark, sf_dir, "f_geno"), path)
    _, geno = io.read_vcf(spark, path)
    return geno.drop("site_id")


@register("sample_sheet_scan", with_fixtures(["f_sheet"], "SELECT strain, bam FROM f_sheet"), "A")
def q_sample_sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "sheet")
    io.write_table(fixture(spark, sf_dir, "f_sheet").select("strain", "bam", "bai"), path, header=False)
    return io.read_sample_sheet(spark, path)


@register("rename_map_scan", with_fixtures(["f_rename"], "SELECT ref_strain, isotype FROM f_rename"), "A")
def q_rename_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "rename")
    io.write_table(fixture(spark, sf_dir, "f_rename"), path, header=False)
    return io.read_rename_map(spark, path)


@register("dimension_scan", with_fixtures(["f_chrom"], "SELECT chrom, chrom_length FROM f_chrom"), "A")
def q_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "lengths")
    lengths = fixture(spark, sf_dir, "f_chrom").select(F.col("chrom").alias("CHROM"), F.lit(1).alias("start"), F.col("chrom_length").alias("stop"))
    io.write_table(lengths.coalesce(1), path, header=True)
    return io.read_chrom_lengths(spark, path)


@register("segment_scan", with_fixtures(["f_seg"], "SELECT * FROM f_seg"), "A")
def q_segment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "ibd")
    io.write_table(fixture(spark, sf_dir, "f_seg").repartition("chrom"), path, header=False)  # one file set per chromosome
    return io.read_segments(spark, path)


@register(
    "mask_scan",
    with_fixtures(["f_mask"], "SELECT strain, chrom, start_bin, end_bin, var_count, coverage FROM f_mask"),
    "A",
)
def q_mask_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "mask")
    m = fixture(spark, sf_dir, "f_mask").select(
        "strain",
        F.col("chrom").alias("CHROM"),
        F.col("start_bin").alias("START_BIN"),
        F.col("end_bin").alias("END_BIN"),
        F.col("var_count").alias("VAR_COUNT"),
        F.col("coverage").alias("COVERAGE"),
    )
    io.write_table(m, path, header=True, partition_by=["strain"])
    return io.read_masks(spark, path)


@register("strain_count", with_fixtures(["f_mask"], "SELECT COUNT(DISTINCT strain) AS strain_count FROM f_mask"), "A")
def q_strain_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of mask files (strains) in the scan."""
    path = io.scratch_path(spark, "mask")
    m = fixture(spark, sf_dir, "f_mask").select(
        "strain", F.col("chrom").alias("CHROM"), F.col("start_bin").alias("START_BIN"), F.col("end_bin").alias("END_BIN"),
        F.col("var_count").alias("VAR_COUNT"), F.col("coverage").alias("COVERAGE"),
    )
    io.write_table(m, path, header=True, partition_by=["strain"])
    return D.strain_count(io.read_masks(spark, path))


@register("annotation_scan", with_fixtures(["f_annot"], "SELECT chrom, start_pos, end_pos, CAST(cm AS VARCHAR) AS cM FROM f_annot"), "A")
def q_annotation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "annot")
    io.write_table(fixture(spark, sf_dir, "f_annot").select("chrom", "start_pos", "end_pos", "cm"), path, fmt="bed")
    (df, _name, _op), = io.read_annotations(spark, [{"file": path, "columns": [4], "names": ["cM"], "ops": ["self"]}])
    return df


@register(
    "table_sink",
    divergent_sql("SELECT chrom, cluster_start, cluster_end, strain FROM reg"),
    "A",
)
def q_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The divergent-region BED (chrom, start, end, strain; no header) read back."""
    path = io.scratch_path(spark, "bed")
    regions = D.divergent_regions(fixture(spark, sf_dir, "f_mask")).select("chrom", "cluster_start", "cluster_end", "strain")
    io.write_table(regions, path, fmt="bed")
    schema = "chrom string, cluster_start bigint, cluster_end bigint, strain string"
    return spark.read.csv(path, schema=schema, sep="\t")


@register(
    "collate_runs",
    _gsql(
        "SELECT t.ld, COUNT(*) AS pairs_above FROM (SELECT r2 FROM ("
        "SELECT CASE WHEN vx > 0 AND vy > 0 THEN (cv * cv) / (vx * vy) END AS r2 FROM ("
        "SELECT COUNT(*) * SUM(x * x) - SUM(x) * SUM(x) AS vx, COUNT(*) * SUM(y * y) - SUM(y) * SUM(y) AS vy, "
        "COUNT(*) * SUM(x * y) - SUM(x) * SUM(y) AS cv FROM xy GROUP BY chrom, site1, site2))) p "
        "JOIN (SELECT 0.8 AS ld UNION ALL SELECT 0.6) t ON p.r2 > t.ld GROUP BY t.ld",
        ["f_site"],
        _LD,
    ),
    "A",
)
def q_collate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-setting result tables (site pairs above each swept r^2
    threshold) written with ``partitionBy('ld')`` and read back as one table."""
    path = io.scratch_path(spark, "runs")
    g = V.biallelic_sites(V.filter_snps(fixture(spark, sf_dir, "f_geno")))
    r2 = V.ld_r2(g)
    ts = F.array(F.lit(0.8), F.lit(0.6))
    runs = r2.withColumn("ld", F.explode(ts)).filter(F.col("r2") > F.col("ld")).select("ld", "site1", "site2")
    io.write_table(runs, path, fmt="parquet", partition_by=["ld"])
    back = io.collate_runs(spark, path)
    return back.groupBy(F.col("ld").cast("decimal(2,1)").alias("ld")).agg(F.count(F.lit(1)).alias("pairs_above"))


@register("collect_tables", with_fixtures(["f_sheet"], "SELECT strain, bam, bai FROM f_sheet"), "A")
def q_collect_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: one small CSV with header per strain, merged into one table."""
    path = io.scratch_path(spark, "onerow")
    io.write_table(fixture(spark, sf_dir, "f_sheet"), path, fmt="csv", header=True, partition_by=["strain"])
    return io.collect_tables(spark, path).select(F.col("strain").cast("string").alias("strain"), "bam", "bai")


@register(
    "strain_lookup_scan",
    with_fixtures(
        ["f_sheet", "f_rename"],
        "SELECT s.strain, s.strain || '_old' AS previous_names, COALESCE(r.isotype, s.strain) AS isotype "
        "FROM f_sheet s LEFT JOIN f_rename r ON r.ref_strain = s.strain",
    ),
    "A",
)
def q_strain_lookup_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the strain lookup (strain, previous_names, isotype) read back with
    its projection; built from the sample sheet and the rename map."""
    path = io.scratch_path(spark, "lookup")
    sheet = fixture(spark, sf_dir, "f_sheet")
    rename = fixture(spark, sf_dir, "f_rename")
    lookup = sheet.join(rename.withColumnRenamed("ref_strain", "strain"), "strain", "left").select(
        "strain",
        "bam",
        F.concat("strain", F.lit("_old")).alias("previous_names"),
        F.coalesce("isotype", "strain").alias("isotype"),
    )
    io.write_table(lookup, path, header=True)
    return io.read_strain_lookup(spark, path)
