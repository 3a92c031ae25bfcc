"""Readers and writers (inventory A1-A3, A5-A10).

All readers are DataFrame scans with explicit schemas (no inference), so the
planner prunes columns and pushes filters; text formats are split by Spark's
input splits (gzip is not splittable: repartition after reading it).  Writers
never collect: files are written by the executors.
"""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path  # noqa: F401

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("strain1", T.StringType()),
        T.StructField("ind1", T.IntegerType()),
        T.StructField("strain2", T.StringType()),
        T.StructField("ind2", T.IntegerType()),
        T.StructField("chrom", T.StringType()),
        T.StructField("start_pos", T.LongType()),
        T.StructField("stop_pos", T.LongType()),
        T.StructField("lod", T.DoubleType()),
    ]
)

MASK_SCHEMA = T.StructType(
    [
        T.StructField("CHROM", T.StringType()),
        T.StructField("START_BIN", T.LongType()),
        T.StructField("END_BIN", T.LongType()),
        T.StructField("VAR_COUNT", T.LongType()),
        T.StructField("COVERAGE", T.DoubleType()),
    ]
)

BED_SCHEMA = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start_pos", T.LongType()),
        T.StructField("end_pos", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)


def _tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep="\t", header=header)


# --------------------------------------------------------------------- A1
def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A1: VCF text -> (sites, long genotypes).

    Sample names come from the ``#CHROM`` header (``./`` stripped); ``#`` and
    blank lines are skipped; GT is the FORMAT field before the first ``:``.
    The header is exploded to (index, name), bounded by the sample count, and
    joined to the data fields by file and position, so files may list their
    samples in any order.  A file without a header takes that of its folder.
    ``site_id`` is a hash of chrom, pos, ref and alt."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    header = lines.filter(F.col("value").startswith("#CHROM")).select("_file", F.split("value", "\t").alias("f"))
    folder = F.regexp_replace("_file", "[^/]*$", "")
    # a folder written by Spark holds its header in one part file: it counts for the folder
    of_file = header.select("_file", F.posexplode("f").alias("col", "strain")).filter(F.col("col") >= 9)
    names = of_file.select("_file", "col", F.regexp_replace("strain", r"\./", "").alias("strain"))
    data = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select("_file", F.split("value", "\t").alias("f"))
    if any(f.endswith((".gz", ".bgz")) for f in lines.inputFiles()):  # one split per file: spread the rows
        data = data.repartition(2 * spark.sparkContext.defaultParallelism)
    own = header.select("_file", F.lit(True).alias("_own"))
    shared = header.groupBy(folder.alias("_folder")).agg(F.min("_file").alias("_shared"))
    data = (
        data.withColumn("_folder", folder).join(own, "_file", "left").join(shared, "_folder", "left")
        .withColumn("_head", F.when(F.col("_own"), F.col("_file")).otherwise(F.col("_shared")))
        .drop("_file", "_folder", "_own", "_shared")
    )
    sites = data.select(
        F.col("f")[0].alias("chrom"),
        F.col("f")[1].cast("bigint").alias("pos"),
        F.when(F.col("f")[2] == ".", F.lit(None)).otherwise(F.col("f")[2]).alias("id"),
        F.col("f")[3].alias("ref"),
        F.col("f")[4].alias("alt"),
        F.col("f")[5].alias("qual"),
        F.col("f")[6].alias("filter"),
        F.col("f")[7].alias("info"),
        "f",
        "_head",
    ).withColumn("site_id", F.xxhash64("chrom", "pos", "ref", "alt"))
    site = ["site_id", "chrom", "pos", "ref", "alt"]
    fields = F.when(F.size("f") > 9, F.slice("f", F.lit(10), F.size("f") - 9)).otherwise(F.array().cast("array<string>"))
    calls = sites.select(*site, "_head", F.posexplode(fields).alias("_i", "_field")).select(
        *site, "_head", (F.col("_i") + 9).alias("col"), F.substring_index("_field", ":", 1).alias("gt")
    )
    geno = calls.join(names.withColumnRenamed("_file", "_head"), ["_head", "col"]).drop("_head", "col")
    return sites.drop("f", "_head"), geno


def write_vcf(geno: DataFrame, path: str, source: str = "genoframe") -> None:
    """A8 (VCF text): long genotypes -> VCF lines (samples in sorted order),
    header rows included; pivoting to wide happens only here, at the edge."""
    strains = geno.select("strain").distinct()
    head = strains.agg(F.array_sort(F.collect_list("strain")).alias("s")).select(
        F.concat_ws("\t", F.lit("#CHROM"), F.lit("POS"), F.lit("ID"), F.lit("REF"), F.lit("ALT"), F.lit("QUAL"),
                    F.lit("FILTER"), F.lit("INFO"), F.lit("FORMAT"), F.array_join("s", "\t")).alias("value")
    )
    meta = strains.agg(F.count(F.lit(1))).select(F.lit(f"##fileformat=VCFv4.2\n##source={source}").alias("value"))
    body = geno.groupBy("chrom", "pos", "ref", "alt").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("strain", "gt"))), lambda x: x["gt"]).alias("gts")
    )
    rows = body.select(
        F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"),
                    F.lit("."), F.lit("GT"), F.array_join("gts", "\t")).alias("value")
    )
    meta.unionByName(head).unionByName(rows).write.mode("overwrite").text(path)


# --------------------------------------------------------------------- A2 / A3
def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A2: headerless TSV strain, bam, bai; keep the first two columns."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("strain", "bam", "bai")])
    return _tsv(spark, path, schema).select("strain", "bam")


def read_rename_map(spark: SparkSession, path: str) -> DataFrame:
    """A3: headerless ref_strain -> isotype map."""
    schema = T.StructType([T.StructField("ref_strain", T.StringType()), T.StructField("isotype", T.StringType())])
    return _tsv(spark, path, schema)


def read_chrom_lengths(spark: SparkSession, path: str) -> DataFrame:
    """A3: chromosome lengths with header ``CHROM start stop`` (1-based)."""
    schema = T.StructType(
        [T.StructField("CHROM", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]
    )
    return _tsv(spark, path, schema, header=True).select(F.col("CHROM").alias("chrom"), F.col("stop").alias("chrom_length"))


def read_strain_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A3: strain lookup projected to strain, previous_names, isotype."""
    return spark.read.csv(path, sep="\t", header=True).select("strain", "previous_names", "isotype")


# --------------------------------------------------------------------- A5 / A6 / A7
def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A5: per-chromosome pair-segment files (headerless, 8 columns) as one table."""
    return _tsv(spark, path, SEGMENT_SCHEMA)


def read_masks(spark: SparkSession, path: str) -> DataFrame:
    """Every ``<strain>_Mask_DF.tsv`` (header CHROM START_BIN END_BIN
    VAR_COUNT COVERAGE) in one scan; the strain is taken from the file name
    (or from a ``strain=`` partition folder)."""
    df = _tsv(spark, path, MASK_SCHEMA, header=True).select("*", F.col("_metadata.file_path").alias("_file"))
    from_name = F.regexp_extract("_file", r"([^/]+)_Mask_DF\.tsv$", 1)
    from_dir = F.regexp_extract("_file", r"/strain=([^/]+)/", 1)
    strain = F.when(from_name != "", from_name).otherwise(from_dir)
    return df.select(
        strain.alias("strain"),
        F.col("CHROM").alias("chrom"),
        F.col("START_BIN").alias("start_bin"),
        F.col("END_BIN").alias("end_bin"),
        F.col("VAR_COUNT").alias("var_count"),
        F.col("COVERAGE").alias("coverage"),
    )


def read_annotations(spark: SparkSession, sources: list[dict]) -> list[tuple[DataFrame, str, str]]:
    """Annotation BEDs configured as ``{file, columns, names, ops}``
    entries; returns (intervals, name, op) for every value column."""
    out = []
    for src in sources:
        columns = [int(c) for c in src["columns"]]
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, max(*columns, 4) + 1)])
        rows = _tsv(spark, src["file"], schema)
        for col, name, op in zip(columns, src["names"], src["ops"], strict=True):
            df = rows.select(
                F.col("c1").alias("chrom"),
                F.col("c2").cast("bigint").alias("start_pos"),
                F.col("c3").cast("bigint").alias("end_pos"),
                F.col(f"c{col}").alias(name),
            )
            out.append((df, name, op))
    return out


def annotation_config(text: str) -> list[dict]:
    """The ``[[annotation]]`` tables of a TOML annotation configuration."""
    return [dict(a) for a in tomllib.loads(text)["annotation"]]


# --------------------------------------------------------------------- A8
def write_table(
    df: DataFrame, path: str, fmt: str = "tsv", header: bool = True, partition_by: list[str] | None = None
) -> None:
    """TSV / BED / CSV with or without header, or Parquet; optionally
    partitioned (e.g. by chrom) for partition pruning downstream.  A task sorts
    what it writes by the partition columns, so its share is set by size first
    (a rebalance splits large partitions and joins small ones)."""
    if partition_by:
        w = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").partitionBy(*partition_by)
    else:
        w = df.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.csv(path, header=header)
    else:  # tsv, bed
        w.csv(path, sep="\t", header=header and fmt != "bed")


# --------------------------------------------------------------------- A9 / A10
def collate_runs(spark: SparkSession, path: str) -> DataFrame:
    """The result tables of many runs, written with ``partitionBy`` on
    their settings, read back as one table through partition discovery."""
    return spark.read.parquet(path)


def collect_tables(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """A10: many small CSVs with headers as one table (one header kept)."""
    return spark.read.csv(paths, header=True, inferSchema=False)
