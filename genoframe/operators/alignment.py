"""Alignment and tree-input operators (inventory F1-F8).

Sites pass when enough samples are called and REF and every ALT are single
bases; each call becomes one IUPAC character of its sorted distinct bases.
The transpose to one sequence per strain is a two-level ``collect_list``:
pieces per (strain, chrom, site block), then the pieces per strain, so no
task sorts a whole strain.  Pairwise distances are block GEMMs of one-hot
site chunks (numpy inside ``applyInPandas``), pre-aggregated per chunk: the
shuffle carries one n x n partial per chunk, never one row per site and pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import genotype as G
from ..functions.contigs import contig_rank
from ..functions.ranking import block_rank
from ..session import ship_package

# Minimum called samples per site (capped at the sample count).
MIN_SAMPLES_LOCUS = 4

# IUPAC code of a call's sorted distinct bases; lower case when
# '*' (deletion) or N (missing) is among them.
IUPAC = {"*": "-", "A": "A", "C": "C", "G": "G", "N": "N", "T": "T",
         "*A": "a", "*C": "c", "*G": "g", "*N": "n", "*T": "t",
         "AC": "M", "AG": "R", "AN": "a", "AT": "W", "CG": "S",
         "CN": "c", "CT": "Y", "GN": "g", "GT": "K", "NT": "t",
         "*AC": "m", "*AG": "r", "*AN": "a", "*AT": "w", "*CG": "s",
         "*CN": "c", "*CT": "y", "*GN": "g", "*GT": "k", "*NT": "t",
         "ACG": "V", "ACN": "m", "ACT": "H", "AGN": "r", "AGT": "D",
         "ANT": "w", "CGN": "s", "CGT": "B", "CNT": "y", "GNT": "k",
         "*ACG": "v", "*ACN": "m", "*ACT": "h", "*AGN": "r", "*AGT": "d",
         "*ANT": "w", "*CGN": "s", "*CGT": "b", "*CNT": "y", "*GNT": "k",
         "ACGN": "v", "ACGT": "N", "ACNT": "h", "AGNT": "d", "CGNT": "b",
         "*ACGN": "v", "*ACGT": "N", "*ACNT": "h", "*AGNT": "d", "*CGNT": "b",
         "*ACGNT": "N"}

# Binary SNP coding of diploid calls (0 hom-ref, 1 het, 2 hom-alt).
GEN_BIN = {"./.": "?", ".|.": "?", "0/0": "0", "0|0": "0", "0/1": "1", "0|1": "1",
           "1/0": "1", "1|0": "1", "1/1": "2", "1|1": "2"}

UNCALLED = ["N", "n", "-"]


def _map(d: dict[str, str]) -> F.Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def normalized_gt(gt: F.Column | str = "gt", ploidy: int = 2) -> F.Column:
    """A call starting with '.' is wholly missing: it becomes './.' (ploidy)."""
    c = F.col(gt) if isinstance(gt, str) else gt
    return F.when(G.is_wholly_missing(c), F.lit("/".join(["."] * ploidy))).otherwise(c)


# --------------------------------------------------------------------- F1
def alignment_sites(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS) -> DataFrame:
    """per site, the called-sample count and whether the site is kept:
    called >= min(min_samples, n) and REF / every ALT a single base (the ALT
    field's length minus its commas equals the number of ALTs)."""
    n = geno.select("strain").distinct().agg(F.count(F.lit(1))).scalar()
    sites = geno.groupBy("site_id", "chrom", "pos", "ref", "alt").agg(
        F.sum(F.when(G.is_wholly_missing("gt"), 0).otherwise(1)).alias("n_called")
    )
    commas = F.length("alt") - F.length(F.regexp_replace("alt", ",", ""))
    snp = (F.length("ref") == 1) & (F.length("alt") - commas == commas + 1)
    shallow = F.col("n_called") < F.least(F.lit(min_samples), n)
    return sites.withColumn("shallow", shallow).withColumn("snp", snp).withColumn(
        "accepted", ~F.col("shallow") & F.col("snp")
    ).withColumn("biallelic", F.col("accepted") & (F.length("alt") == 1))


# --------------------------------------------------------------------- F3
def iupac_calls(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS) -> DataFrame:
    """one IUPAC character per (accepted site, strain).  A site where
    some call has no code is malformed and skipped entirely."""
    sites = alignment_sites(geno, min_samples).filter("accepted").select("site_id", "biallelic")
    g = geno.join(sites, "site_id")
    bases = F.transform(G.allele_bases("ref", "alt"), lambda b: F.regexp_replace(b, "-", "*"))
    alle = F.transform(
        F.split(normalized_gt("gt"), "[/|]"),
        lambda a: F.when(a == ".", F.lit("N")).otherwise(F.element_at(bases, a.cast("int") + 1)),
    )
    key = F.array_join(F.array_sort(F.array_distinct(alle)), "")
    g = g.withColumn("base", F.element_at(_map(IUPAC), key))
    bad = F.max(F.col("base").isNull().cast("int")).over(Window.partitionBy("site_id"))
    return g.withColumn("_bad", bad).filter(F.col("_bad") == 0).drop("_bad")


def site_counters(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS) -> DataFrame:
    """processed, too shallow, not SNP, accepted (written) and biallelic
    site counts in one aggregate."""
    s = alignment_sites(geno, min_samples)
    written = iupac_calls(geno, min_samples).select("site_id").distinct().withColumn("_w", F.lit(1))
    s = s.join(written, "site_id", "left")
    b = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return s.agg(
        F.count(F.lit(1)).alias("processed"),
        b(F.col("shallow")).alias("too_shallow"),
        b(~F.col("shallow") & ~F.col("snp")).alias("not_snp"),
        b(F.col("_w").isNotNull()).alias("accepted"),
        b(F.col("_w").isNotNull() & F.col("biallelic")).alias("biallelic"),
    )


# --------------------------------------------------------------------- F4
def resolve_heterozygous(geno: DataFrame, seed: int = 42) -> DataFrame:
    """each call replaced by one of its alleles, chosen by a seeded hash
    of (site, strain): reproducible, unlike a random draw."""
    parts = F.split(normalized_gt("gt"), "[/|]")
    pick = F.element_at(parts, (F.abs(F.xxhash64("site_id", "strain", F.lit(seed))) % F.size(parts) + 1).cast("int"))
    sep = F.when(F.col("gt").contains("|"), F.lit("|")).otherwise(F.lit("/"))
    resolved = F.array_join(F.transform(parts, lambda _: pick), "/")
    return geno.select(
        "site_id", "strain", "gt", F.when(sep == "|", F.regexp_replace(resolved, "/", "|")).otherwise(resolved).alias("gt_resolved")
    )


# --------------------------------------------------------------------- F5
def binary_matrix(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS) -> DataFrame:
    """0/1/2 (missing ``?``) per call at written biallelic sites."""
    calls = iupac_calls(geno, min_samples).filter("biallelic")
    return calls.select("site_id", "strain", F.element_at(_map(GEN_BIN), F.substring(normalized_gt("gt"), 1, 3)).alias("code"))


# --------------------------------------------------------------------- F6
def _transpose(calls: DataFrame, char_col: str, block: int) -> DataFrame:
    c = calls.withColumn("_crank", contig_rank("chrom")).withColumn("_blk", F.floor(F.col("pos") / block).cast("bigint"))
    pieces = c.groupBy("strain", "_crank", "chrom", "_blk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "site_id", char_col))), lambda x: x[char_col]), "").alias("_piece"),
        F.count(F.lit(1)).alias("_n"),
    )
    return pieces.groupBy("strain").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_crank", "chrom", "_blk", "_piece"))), lambda x: x["_piece"]), ""
        ).alias("seq"),
        F.sum("_n").alias("n_sites"),
    )


def alignment_by_strain(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS, block: int = 1_000_000) -> DataFrame:
    """one sequence per strain, sites in genome order."""
    return _transpose(iupac_calls(geno, min_samples), "base", block)


def binary_by_strain(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS, block: int = 1_000_000) -> DataFrame:
    return _transpose(binary_matrix(geno, min_samples).join(geno.select("site_id", "chrom", "pos").distinct(), "site_id"), "code", block)


# --------------------------------------------------------------------- F7
def alignment_text(
    seqs: DataFrame, fmt: str = "phylip", outgroup: str | None = None, datatype: str | None = None
) -> DataFrame:
    """output lines (``line_no``, ``line``) of a PHYLIP, FASTA, NEXUS or
    binary NEXUS (``fmt='bin_nexus'``) file; names padded to the longest
    name + 3; the outgroup first, then strains in sample order."""
    longest = seqs.agg(F.max(F.length("strain"))).scalar()
    ntax = seqs.agg(F.count(F.lit(1))).scalar()
    nchar = seqs.agg(F.max("n_sites")).scalar()
    # the names alone are ranked (one row per sample); sequences join back
    order = Window.orderBy(F.when(F.col("strain") == F.lit(outgroup), 0).otherwise(1), "strain")
    ranks = seqs.select("strain").withColumn("_i", F.row_number().over(order).cast("bigint"))
    body = seqs.join(ranks, "strain")
    named = F.concat(F.rpad("strain", longest + 3, " "), F.col("seq"))
    one = seqs.agg(F.count(F.lit(1)).alias("_rows"))  # exactly one row, for header / footer lines

    def header(lines: list[F.Column]) -> DataFrame:
        return one.select(F.posexplode(F.array(*lines)).alias("_p", "line")).select(
            (F.col("_p") - 1000).cast("bigint").alias("line_no"), "line"
        )

    if fmt == "phylip":
        head = header([F.concat_ws(" ", ntax.cast("string"), nchar.cast("string"))])
        lines = body.select((F.col("_i") * 2).alias("line_no"), named.alias("line"))
        return head.unionByName(lines)
    if fmt == "fasta":
        a = body.select((F.col("_i") * 2).alias("line_no"), F.concat(F.lit(">"), F.col("strain")).alias("line"))
        b = body.select((F.col("_i") * 2 + 1).alias("line_no"), F.col("seq").alias("line"))
        return a.unionByName(b)
    dtype, missing = ("SNP", "?") if fmt == "bin_nexus" else ("DNA", "N")
    head = header(
        [
            F.lit("#NEXUS"),
            F.lit(""),
            F.lit("BEGIN DATA;"),
            F.concat(F.lit("\tDIMENSIONS NTAX="), ntax.cast("string"), F.lit(" NCHAR="), nchar.cast("string"), F.lit(";")),
            F.lit(f"\tFORMAT DATATYPE={datatype or dtype} MISSING={missing} GAP=- ;"),
            F.lit("MATRIX"),
        ]
    )
    lines = body.select((F.col("_i") * 2).alias("line_no"), named.alias("line"))
    tail = one.select(F.posexplode(F.array(F.lit(";"), F.lit("END;"))).alias("_p", "line")).select(
        (F.col("_p") + 10**12).cast("bigint").alias("line_no"), "line"
    )
    return head.unionByName(lines).unionByName(tail)


# --------------------------------------------------------------------- F8
_DIST = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("called", T.LongType()),
        T.StructField("matched", T.LongType()),
    ]
)


def _chunk_distance(pdf: pd.DataFrame) -> pd.DataFrame:
    chars = np.array(pdf["chars"].tolist())  # m x n single characters
    called = ~np.isin(chars, UNCALLED)
    c = called.astype(np.float64)
    both = c.T @ c
    same = np.zeros_like(both)
    for sym in np.unique(chars[called]):
        x = ((chars == sym) & called).astype(np.float64)
        same += x.T @ x
    ii, jj = np.triu_indices(chars.shape[1], 1)
    return pd.DataFrame(
        {
            "i": ii.astype(np.int32),
            "j": jj.astype(np.int32),
            "called": np.rint(both[ii, jj]).astype(np.int64),
            "matched": np.rint(same[ii, jj]).astype(np.int64),
        }
    )


def pairwise_distance(geno: DataFrame, min_samples: int = MIN_SAMPLES_LOCUS, chunk: int = 4096) -> DataFrame:
    """F8: for every strain pair, mismatching characters / sites where both
    are called (not N, n or -)."""
    ship_package(geno.sparkSession)
    calls = iupac_calls(geno, min_samples)
    # strain index from the input's strain list (bounded by the sample count),
    # not from the consensus calls, so the consensus plan runs once
    strains = geno.select("strain").distinct()
    strains = strains.withColumn("sidx", (F.row_number().over(Window.orderBy("strain")) - 1).cast("int"))
    n = strains.agg(F.count(F.lit(1))).scalar()
    per_site = calls.join(strains, "strain").groupBy("site_id", "chrom", "pos").agg(
        F.collect_list(F.struct("sidx", "base")).alias("_e")
    )
    per_site = per_site.withColumn("_n", n.cast("int")).withColumn("chars", G.dense("_e", "_n", "base", F.lit("N"))).drop("_e", "_n")
    ranked = block_rank(per_site, "chrom", "pos", "idx", tiebreak="site_id")
    ranked = ranked.withColumn("chunk", F.floor((F.col("idx") - 1) / chunk).cast("bigint"))
    parts = ranked.select("chrom", "chunk", "chars").groupBy("chrom", "chunk").applyInPandas(_chunk_distance, _DIST)
    tot = parts.groupBy("i", "j").agg(F.sum("called").alias("called"), F.sum("matched").alias("matched"))
    s1 = strains.select(F.col("sidx").alias("i"), F.col("strain").alias("strain1"))
    s2 = strains.select(F.col("sidx").alias("j"), F.col("strain").alias("strain2"))
    return tot.join(s1, "i").join(s2, "j").select(
        "strain1",
        "strain2",
        "called",
        (F.col("called") - F.col("matched")).alias("mismatches"),
        F.when(F.col("called") > 0, (F.col("called") - F.col("matched")) / F.col("called")).alias("distance"),
    )
