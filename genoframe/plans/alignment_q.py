"""Alignment and tree-input queries (F1-F8) over ``f_geno``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contigs import contig_rank_sql
from ..operators import alignment as A
from ..sources.fixtures import fixture, with_fixtures
from .catalog import register

# The IUPAC table is a fixed value list shared by both engines; the rest of the
# oracle (call parsing, site rules, ordering) is written separately in SQL.
_IUPAC_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in A.IUPAC.items())

_F = [
    ("ns", "SELECT COUNT(DISTINCT strain) AS n FROM f_geno"),
    (
        "st",
        "SELECT site_id, chrom, pos, ref, alt, CAST(SUM(CASE WHEN gt LIKE '.%' THEN 0 ELSE 1 END) AS BIGINT) AS n_called FROM f_geno GROUP BY site_id, chrom, pos, ref, alt",
    ),
    (
        "st2",
        "SELECT *, n_called < LEAST(4, (SELECT n FROM ns)) AS shallow, length(ref) = 1 AND "
        "length(alt) - (length(alt) - length(replace(alt, ',', ''))) = (length(alt) - length(replace(alt, ',', ''))) + 1 AS snp FROM st",
    ),
    ("acc", "SELECT *, length(alt) = 1 AS biallelic FROM st2 WHERE NOT shallow AND snp"),
    ("iupac(k, v)", f"VALUES {_IUPAC_VALUES}"),
    (
        "cl",
        "SELECT g.site_id, g.chrom, g.pos, g.strain, g.gt, a.biallelic, "
        "CASE WHEN g.gt LIKE '.%' THEN '.' ELSE split_part(g.gt, '/', 1) END AS a1, "
        "CASE WHEN g.gt LIKE '.%' THEN '.' ELSE split_part(g.gt, '/', 2) END AS a2, g.ref, g.alt FROM f_geno g JOIN acc a ON a.site_id = g.site_id",
    ),
    (
        "cb",
        "SELECT *, replace(CASE WHEN a1 = '.' THEN 'N' WHEN a1 = '0' THEN ref ELSE split_part(alt, ',', CAST(a1 AS INT)) END, '-', '*') AS b1, "
        "replace(CASE WHEN a2 = '.' THEN 'N' WHEN a2 = '0' THEN ref ELSE split_part(alt, ',', CAST(a2 AS INT)) END, '-', '*') AS b2 FROM cl",
    ),
    (
        "ck",
        "SELECT *, CASE WHEN b1 = b2 THEN b1 WHEN b1 < b2 THEN b1 || b2 ELSE b2 || b1 END AS k FROM cb",
    ),
    ("cons0", "SELECT ck.*, iupac.v AS base FROM ck LEFT JOIN iupac ON iupac.k = ck.k"),
    ("cons", "SELECT * FROM cons0 WHERE site_id NOT IN (SELECT site_id FROM cons0 WHERE base IS NULL)"),
    (
        "seqs",
        f"SELECT strain, string_agg(base, '' ORDER BY {contig_rank_sql('chrom')}, pos, site_id) AS seq, COUNT(*) AS n_sites FROM cons GROUP BY strain",
    ),
]


def _sql(body: str) -> str:
    return with_fixtures(["f_geno"], body, _F)


def _geno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_geno")


@register("alignment_sites", _sql("SELECT site_id, n_called, shallow, snp, NOT shallow AND snp AS accepted FROM st2"), "F")
def q_alignment_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alignment_sites(_geno(spark, sf_dir)).select("site_id", "n_called", "shallow", "snp", "accepted")


@register(
    "site_counters",
    _sql(
        "SELECT COUNT(*) AS processed, CAST(SUM(CASE WHEN shallow THEN 1 ELSE 0 END) AS BIGINT) AS too_shallow, "
        "CAST(SUM(CASE WHEN NOT shallow AND NOT snp THEN 1 ELSE 0 END) AS BIGINT) AS not_snp, "
        "(SELECT COUNT(DISTINCT site_id) FROM cons) AS accepted, "
        "(SELECT COUNT(DISTINCT site_id) FROM cons WHERE biallelic) AS biallelic FROM st2"
    ),
    "F",
)
def q_site_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.site_counters(_geno(spark, sf_dir))


@register("iupac_consensus", _sql("SELECT site_id, strain, base FROM cons"), "F")
def q_iupac_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.iupac_calls(_geno(spark, sf_dir)).select("site_id", "strain", "base")


@register("resolve_heterozygous", None, "F")
def q_resolve_heterozygous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seeded per-call choice; checked by invariants (the allele is one of the call's)."""
    return A.resolve_heterozygous(_geno(spark, sf_dir))


@register(
    "binary_matrix",
    _sql(
        "SELECT site_id, strain, CASE substr(CASE WHEN gt LIKE '.%' THEN './.' ELSE gt END, 1, 3) "
        "WHEN './.' THEN '?' WHEN '0/0' THEN '0' WHEN '0/1' THEN '1' WHEN '1/0' THEN '1' WHEN '1/1' THEN '2' END AS code FROM cons WHERE biallelic"
    ),
    "F",
)
def q_binary_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.binary_matrix(_geno(spark, sf_dir))


@register("alignment_by_strain", _sql("SELECT strain, seq, n_sites FROM seqs"), "F")
def q_alignment_by_strain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alignment_by_strain(_geno(spark, sf_dir))


def _padded() -> str:
    return "rpad(strain, CAST((SELECT MAX(length(strain)) FROM seqs) + 3 AS INTEGER), ' ') || seq"


@register(
    "alignment_text",
    _sql(
        "SELECT CAST(-1000 AS BIGINT) AS line_no, CAST((SELECT COUNT(*) FROM seqs) AS VARCHAR) || ' ' || CAST((SELECT MAX(n_sites) FROM seqs) AS VARCHAR) AS line "
        f"UNION ALL SELECT 2 * ROW_NUMBER() OVER (ORDER BY strain), {_padded()} FROM seqs"
    ),
    "F",
)
def q_alignment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, PHYLIP lines."""
    return A.alignment_text(A.alignment_by_strain(_geno(spark, sf_dir)), "phylip")


@register(
    "alignment_fasta",
    _sql(
        "SELECT 2 * ROW_NUMBER() OVER (ORDER BY strain) AS line_no, '>' || strain AS line FROM seqs "
        "UNION ALL SELECT 2 * ROW_NUMBER() OVER (ORDER BY strain) + 1, seq FROM seqs"
    ),
    "F",
)
def q_alignment_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alignment_text(A.alignment_by_strain(_geno(spark, sf_dir)), "fasta")


def _nexus_sql(dtype: str, missing: str, seqs: str) -> str:
    head = ["#NEXUS", "", "BEGIN DATA;"]
    rows = [f"SELECT CAST({i - 1000} AS BIGINT) AS line_no, '{t}' AS line" for i, t in enumerate(head)]
    rows.append(
        f"SELECT CAST(-997 AS BIGINT), chr(9) || 'DIMENSIONS NTAX=' || CAST((SELECT COUNT(*) FROM {seqs}) AS VARCHAR) || ' NCHAR=' || "
        f"CAST((SELECT MAX(n_sites) FROM {seqs}) AS VARCHAR) || ';'"
    )
    rows.append(f"SELECT CAST(-996 AS BIGINT), chr(9) || 'FORMAT DATATYPE={dtype} MISSING={missing} GAP=- ;'")
    rows.append("SELECT CAST(-995 AS BIGINT), 'MATRIX'")
    rows.append(
        f"SELECT 2 * ROW_NUMBER() OVER (ORDER BY strain), rpad(strain, CAST((SELECT MAX(length(strain)) FROM {seqs}) + 3 AS INTEGER), ' ') || seq FROM {seqs}"
    )
    rows.append("SELECT CAST(1000000000000 AS BIGINT), ';'")
    rows.append("SELECT CAST(1000000000001 AS BIGINT), 'END;'")
    return " UNION ALL ".join(rows)


@register("alignment_nexus", _sql(_nexus_sql("DNA", "N", "seqs")), "F")
def q_alignment_nexus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alignment_text(A.alignment_by_strain(_geno(spark, sf_dir)), "nexus")


@register(
    "alignment_bin_nexus",
    with_fixtures(
        ["f_geno"],
        _nexus_sql("SNP", "?", "bseqs"),
        _F
        + [
            (
                "bcode",
                "SELECT site_id, chrom, pos, strain, CASE substr(CASE WHEN gt LIKE '.%' THEN './.' ELSE gt END, 1, 3) "
                "WHEN './.' THEN '?' WHEN '0/0' THEN '0' WHEN '0/1' THEN '1' WHEN '1/0' THEN '1' WHEN '1/1' THEN '2' END AS code FROM cons WHERE biallelic",
            ),
            (
                "bseqs",
                f"SELECT strain, string_agg(code, '' ORDER BY {contig_rank_sql('chrom')}, pos, site_id) AS seq, COUNT(*) AS n_sites FROM bcode GROUP BY strain",
            ),
        ],
    ),
    "F",
)
def q_alignment_bin_nexus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alignment_text(A.binary_by_strain(_geno(spark, sf_dir)), "bin_nexus")


@register(
    "pairwise_distance",
    _sql(
        "SELECT a.strain AS strain1, b.strain AS strain2, COUNT(*) AS called, "
        "CAST(SUM(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) AS BIGINT) AS mismatches, "
        "SUM(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) / COUNT(*) AS distance "
        "FROM cons a JOIN cons b ON a.site_id = b.site_id AND a.strain < b.strain "
        "WHERE a.base NOT IN ('N', 'n', '-') AND b.base NOT IN ('N', 'n', '-') GROUP BY a.strain, b.strain"
    ),
    "F",
)
def q_pairwise_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pairwise_distance(_geno(spark, sf_dir)).withColumn("distance", F.col("distance"))
