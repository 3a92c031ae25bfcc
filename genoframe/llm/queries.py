"""The registered queries of this subpackage: name -> builder, name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctw, decontaminate, dialogue, langid, line_dedup, minhash, mixing, phrases, pii, quality, secret_scan, topk, warc
from .common import table, text_of


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("_h")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("_doc").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("found", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("_doc").alias("doc_id"),
        *[pii.counted("base", kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per id; of an id with several texts, the smallest component and
    the shingles of the text with the smallest hash."""
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4).withColumnRenamed("id", "doc_id")
    return out.groupBy("doc_id").agg(
        F.min_by("n_shingles", "_h").alias("n_shingles"),
        F.min("component_id").alias("component_id"),
        F.max("n_links").alias("n_links"),
        F.max("kept").alias("_kept"),
    ).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), "_kept").alias("kept"), "n_links")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("uri")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length(text_of()).cast("long").alias("kept_chars"),
        F.sha2(text_of(), 256).alias("text_sha256"),
    )


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.find(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        *[secret_scan.counted("base", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.joined("base"), 256).alias("base_sha256"),
        secret_scan.joined("spans").alias("spans"),
    )


def op12_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_decontamination, op3_pii, op4_mixing, op5_langid, op6_minhash, op7_warc, op8_topk, op9_line_dedup, op10_ctw,
        op11_secrets, op12_dialogue, op13_phrases,
    )
}

ORACLES: dict[str, str] = {"op2_decontamination": decontaminate.ORACLE, "op4_mixing": mixing.ORACLE, "op8_topk": topk.ORACLE, "op9_line_dedup": line_dedup.ORACLE, "op13_phrases": phrases.ORACLE}
