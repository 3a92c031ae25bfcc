"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination,
mixing.  Every stage takes (spark, docs, sf_dir) and works on all rows of
``docs``; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import decontaminate, line_dedup, minhash, mixing, quality
from genoframe.llm.common import table
from genoframe.session import ship_package, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines.  A document of which nothing
    is left goes (each of its lines stays at its first place elsewhere);
    ``n_chars`` follows a changed text."""
    ship_package(spark)
    out = line_dedup.remove_boilerplate(docs)
    out = out.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    ship_package(spark)
    return minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with size, source_size, target and taken."""
    ship_package(spark)
    return mixing.mix(docs).filter(F.col("taken") > 0)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The quality classifier has no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
