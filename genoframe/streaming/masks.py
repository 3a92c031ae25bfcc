"""Incremental divergent-region calling as per-strain mask files arrive.

In the reference, one job per strain writes ``<strain>_Mask_DF.tsv`` and a
final fan-in step calls regions for all strains at once.  Region calling per
strain (D1-D7, D9-D10) only reads that strain's own bins, so the files can be
consumed as a file stream: each micro-batch holds whole files (whole
strains), regions are called for those strains with the batch operators and
appended to a Parquet table partitioned by strain.  The population frequency
(D8) still needs every strain and stays a batch query over the appended
masks.  Progress is kept in a checkpoint under the shared checkpoint folder,
so a restarted or failed stream resumes without duplicating output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.divergent import divergent_regions
from ..session import checkpoint_dir
from ..sources.io import MASK_SCHEMA


def mask_stream(spark: SparkSession, in_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    """A file stream of mask files with the strain taken from the file name."""
    raw = (
        spark.readStream.schema(MASK_SCHEMA)
        .option("sep", "\t")
        .option("header", "true")
        .option("pathGlobFilter", "*_Mask_DF.tsv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(in_dir)
    )
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)_Mask_DF\.tsv$", 1).alias("strain"),
        F.col("CHROM").alias("chrom"),
        F.col("START_BIN").alias("start_bin"),
        F.col("END_BIN").alias("end_bin"),
        F.col("VAR_COUNT").alias("var_count"),
        F.col("COVERAGE").alias("coverage"),
    )


def start_region_stream(
    spark: SparkSession,
    in_dir: str,
    regions_out: str,
    masks_out: str,
    available_now: bool = True,
    name: str = "divergent_regions",
):
    """Start the stream; returns the StreamingQuery.  Each micro-batch appends
    the strains' masks and their regions (idempotent per batch id)."""
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # a replayed batch overwrites its own folder
        batch.write.mode("overwrite").partitionBy("strain").parquet(f"{masks_out}/batch_id={batch_id}")
        divergent_regions(batch).write.mode("overwrite").partitionBy("strain").parquet(f"{regions_out}/batch_id={batch_id}")

    writer = mask_stream(spark, in_dir).writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
