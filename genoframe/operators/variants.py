"""Variant-table operators (inventory B) on the long genotype table.

Genotypes: one row per (site, strain): ``site_id, chrom, pos, ref, alt,
strain, gt``.  Site-level statistics are windows or aggregates keyed by
``site_id`` (one shuffle on the site key; every site holds at most one row per
sample, so no group grows with the number of sites).  Sample lists, rename
maps and marker lists are joined without hints: AQE turns the join into a
broadcast only when the materialised side is measured to be small.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins as B
from ..functions import genotype as G
from ..functions.contigs import MARKER_CHROM_NAMES, NUCLEAR_CONTIGS
from ..functions.ranking import block_rank
from ..session import materialize, ship_package
from .pruning import forward_kept, greedy_removals

SITE = ["site_id"]

# Allele-frequency bounds of the isotype subset (--min-af / --max-af).
MIN_AF = 0.000001
MAX_AF = 0.999999
# LD pruning window (variants) and step of --indep-pairwise 50 10.
LD_WINDOW = 50
LD_STEP = 10


def site_key():
    """Deterministic site id of a record without one."""
    return F.xxhash64("chrom", "pos", "ref", "alt")


# --------------------------------------------------------------------- B1
def subset_samples(geno: DataFrame, sheet: DataFrame, strain_col: str = "strain") -> DataFrame:
    """B1: keep the strains listed in the sample sheet (left semi join)."""
    keep = sheet.select(F.col(strain_col).alias("strain")).dropDuplicates()
    return geno.join(keep, "strain", "left_semi")


# --------------------------------------------------------------------- B2
def polymorphic_sites(geno: DataFrame, min_af: float = MIN_AF, max_af: float = MAX_AF) -> DataFrame:
    """B2: keep sites whose non-reference allele frequency over called alleles
    lies in [min_af, max_af]; sites with no called allele drop."""
    w = Window.partitionBy(*SITE)
    ac = F.sum(G.nonref_alleles("gt")).over(w)
    an = F.sum(G.called_alleles("gt")).over(w)
    return (
        geno.withColumn("_af", F.try_divide(ac, an))  # NULL, and so dropped, without called alleles
        .filter((F.col("_af") >= F.lit(min_af)) & (F.col("_af") <= F.lit(max_af)))
        .drop("_af")
    )


# --------------------------------------------------------------------- B3
def site_counts(geno: DataFrame) -> DataFrame:
    """AC per ALT, AN, AF per ALT and NS (samples with a called allele),
    recomputed from the current genotypes; one row per (site, ALT).
    Two partial aggregates over the calls, joined on the site key."""
    calls = geno.select("site_id", "chrom", "pos", "ref", "alt", G.alleles("gt").alias("_a"))
    per_site = calls.groupBy("site_id", "chrom", "pos", "ref", "alt").agg(
        F.sum(F.size(F.filter("_a", lambda a: a.isNotNull()))).alias("an"),
        F.sum(F.when(F.exists("_a", lambda a: a.isNotNull()), 1).otherwise(0)).alias("ns"),
    )
    ac = (
        calls.select("site_id", F.explode("_a").alias("alt_index"))
        .filter(F.col("alt_index") > 0)
        .groupBy("site_id", "alt_index")
        .agg(F.count(F.lit(1)).alias("ac"))
    )
    alts = per_site.select(
        "site_id", "chrom", "pos", "ref", "an", "ns", F.posexplode(G.alt_list("alt")).alias("_i", "alt_allele")
    ).withColumn("alt_index", (F.col("_i") + 1).cast("int"))
    out = alts.join(ac, ["site_id", "alt_index"], "left").withColumn("ac", F.coalesce("ac", F.lit(0).cast("bigint")))
    return out.select(
        "site_id", "chrom", "pos", "ref", "alt_index", "alt_allele", "ac", "an",
        F.when(F.col("an") > 0, F.col("ac") / F.col("an")).alias("af"), "ns",
    )


# --------------------------------------------------------------------- B4
def rename_samples(geno: DataFrame, rename: DataFrame, src: str = "ref_strain", dst: str = "isotype") -> DataFrame:
    """Strain -> isotype where the map has the strain, else unchanged."""
    m = rename.select(F.col(src).alias("strain"), F.col(dst).alias("_new")).dropDuplicates(["strain"])
    return geno.join(m, "strain", "left").withColumn("strain", F.coalesce("_new", "strain")).drop("_new")


def isotype_table(geno: DataFrame, sheet: DataFrame, rename: DataFrame | None = None) -> DataFrame:
    """B1 -> B2 (-> B4): the isotype-level genotype table."""
    df = polymorphic_sites(subset_samples(geno, sheet))
    return rename_samples(df, rename) if rename is not None else df


# --------------------------------------------------------------------- B5 / B14
def filter_snps(df: DataFrame, mode: str = "all") -> DataFrame:
    """REF one base and every (``all``) or some (``any``) ALT one base."""
    return df.filter(G.is_snp_site("ref", "alt", mode))


def biallelic_sites(df: DataFrame) -> DataFrame:
    """Exactly one ALT allele."""
    return df.filter(F.size(G.alt_list("alt")) == 1)


# --------------------------------------------------------------------- B6 / B7 / B8
def genotype_only(geno: DataFrame) -> DataFrame:
    """Drop INFO and FORMAT fields other than GT (column pruning)."""
    return geno.select("site_id", "chrom", "pos", "ref", "alt", "strain", "gt")


def list_samples(geno: DataFrame) -> DataFrame:
    """Distinct strains with their sorted rank (rank over the distinct
    strain list only, which is bounded by the number of samples)."""
    strains = geno.select("strain").dropDuplicates()
    return strains.withColumn("sample_idx", F.row_number().over(Window.orderBy("strain")).cast("bigint"))


def filter_regions(df: DataFrame, contigs: list[str] | None = None) -> DataFrame:
    """Keep the nuclear contigs (pushed down to the scan / partition pruning)."""
    return df.filter(F.col("chrom").isin(contigs or NUCLEAR_CONTIGS))


# --------------------------------------------------------------------- B9
def merge_multiallelic(geno: DataFrame) -> DataFrame:
    """Records at the same (chrom, pos) become one multi-ALT record.

    REF is the longest one of the position that starts with the record's own;
    a shorter REF and its ALTs are extended by the bases it lacks (symbolic
    ALTs and ``*`` stay).  ALTs are
    the sorted distinct union; each strain's allele indexes are re-mapped into
    it.  A strain with calls in several merged records takes, per allele slot,
    the highest re-mapped allele (a non-reference allele wins over the
    reference; missing only if missing in every record).  Any ploidy; the
    record's ``site_id`` is a hash of chrom, pos, ref and alt.
    """
    # one row per position (its records are a handful, its calls bounded by the samples): the
    # only exchange, the grouping by strain below keeps its partitioning.  The number of tasks
    # is given, since calls take few bytes in a shuffle and far more work after it
    tasks = int(geno.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = geno.repartition(tasks, "chrom", "pos").groupBy("chrom", "pos").agg(F.collect_list(F.struct("ref", "alt", "strain", "gt")).alias("_c"))
    packed = packed.withColumn("_recs", F.array_distinct(F.transform("_c", lambda c: F.struct(c["ref"].alias("ref"), c["alt"].alias("alt")))))

    def merged(rec):
        fitting = F.filter("_recs", lambda o: F.startswith(o["ref"], rec["ref"]))
        longest = F.array_max(F.transform(fitting, lambda o: F.struct(F.length(o["ref"]).alias("n"), o["ref"].alias("r"))))["r"]
        return F.struct(rec["ref"].alias("ref"), rec["alt"].alias("alt"), longest.alias("long"))

    def extended(rec):
        tail = F.substr(rec["long"], F.length(rec["ref"]) + 1)
        old = F.transform(G.alt_list(rec["alt"]), lambda a: F.when(a.rlike("^[A-Za-z]+$"), F.concat(a, tail)).otherwise(a))
        return F.struct(*[rec[c].alias(c) for c in ("ref", "alt", "long")], old.alias("old"))

    def united(rec):
        same = F.filter("_recs", lambda o: o["long"] == rec["long"])
        alts = F.array_sort(F.array_distinct(F.flatten(F.transform(same, lambda o: o["old"]))))
        return F.struct(*[rec[c].alias(c) for c in ("ref", "alt", "long", "old")], alts.alias("alts"))

    for step in (merged, extended, united):
        packed = packed.withColumn("_recs", F.transform("_recs", step))

    def remapped(calls, alts, old):
        return F.transform(
            calls,
            lambda a: F.when(a.isNull(), F.lit(None).cast("int"))
            .when(a == 0, F.lit(0))
            .otherwise(F.array_position(alts, F.element_at(old, a)).cast("int")),
        )

    # the usual position has one record with one call a strain: each distinct call is re-mapped once
    strains = F.transform("_c", lambda c: c["strain"])
    first = F.col("_recs")[0]
    packed = packed.withColumn("_alone", (F.size("_recs") == 1) & first["ref"].isNotNull() & (F.size(F.array_distinct(strains)) == F.size("_c")))
    alone = packed.filter("_alone").select("chrom", "pos", "_c", first.alias("_r"), F.array_distinct(F.transform("_c", lambda c: c["gt"])).alias("_gts"))
    text = lambda calls: F.array_join(F.transform(calls, lambda a: F.coalesce(a.cast("string"), F.lit("."))), "/")
    alone = alone.withColumn("_new", F.transform("_gts", lambda gt: text(remapped(G.alleles(gt), F.col("_r.alts"), F.col("_r.old")))))
    alone = alone.select("chrom", "pos", F.col("_r.long").alias("ref"), F.array_join("_r.alts", ",").alias("alt"), "_gts", "_new", F.explode("_c").alias("_c"))
    gt = F.when(F.col("_c.gt").isNotNull(), F.get("_new", (F.array_position("_gts", F.col("_c.gt")) - 1).cast("int")))
    alone = alone.select("chrom", "pos", "ref", "alt", "_c.strain", gt.alias("gt"))

    g = packed.filter("NOT _alone").select("chrom", "pos", "_recs", F.explode("_c").alias("_c"))
    g = g.withColumn("_r", F.filter("_recs", lambda r: (r["ref"] == F.col("_c.ref")) & r["alt"].eqNullSafe(F.col("_c.alt")))[0])
    g = g.select(
        "chrom", "pos", F.col("_r.long").alias("ref"), F.col("_r.alts").alias("_alts"), F.col("_r.old").alias("_old"), "_c.strain", G.alleles("_c.gt").alias("_al")
    )
    g = g.withColumn("_new", remapped("_al", F.col("_alts"), F.col("_old")))
    key = ["chrom", "pos", "ref"]
    # one list per merged record: a handful per position and strain
    out = g.groupBy(*key, "strain").agg(F.first("_alts").alias("_alts"), F.collect_list("_new").alias("_calls"))
    ploidy = F.array_max(F.transform("_calls", F.size))
    gt = F.transform(
        F.sequence(F.lit(0), ploidy - 1),
        lambda s: F.coalesce(F.array_max(F.transform("_calls", lambda c: F.get(c, s))).cast("string"), F.lit(".")),
    )
    out = out.select(*key, F.array_join("_alts", ",").alias("alt"), "strain", F.array_join(gt, "/").alias("gt"))
    out = alone.unionByName(out)
    return out.withColumn("site_id", site_key())


# --------------------------------------------------------------------- B10 / B11
def target_sites(df: DataFrame, markers: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Keep sites present in a marker list (left semi join)."""
    on = on or ["chrom", "pos"]
    return df.join(markers.select(*on).dropDuplicates(), on, "left_semi")


def exclude_sites(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Drop sites whose ``chrom:pos`` id is in the list (left anti join)."""
    ex = ids.select(F.col(id_col).alias("_xid")).dropDuplicates()
    with_id = df.withColumn("_xid", F.concat_ws(":", "chrom", F.col("pos").cast("string")))
    return with_id.join(ex, "_xid", "left_anti").drop("_xid")


# --------------------------------------------------------------------- B12
def alt_carriers(geno: DataFrame) -> DataFrame:
    """Calls with any non-reference allele, for every strain in one pass."""
    return geno.filter(G.has_alt("gt"))


# --------------------------------------------------------------------- B13
def complete_sites(geno: DataFrame) -> DataFrame:
    """Keep sites where no strain has a missing allele."""
    w = Window.partitionBy(*SITE)
    return geno.withColumn("_any_missing", F.max(G.is_missing("gt")).over(w)).filter(~F.col("_any_missing")).drop("_any_missing")


# --------------------------------------------------------------------- B15
def assign_ids(sites: DataFrame, id_col: str = "id") -> DataFrame:
    """A missing id becomes ``chrom:pos``."""
    current = F.col(id_col) if id_col in sites.columns else F.lit(None).cast("string")
    return sites.withColumn(id_col, F.coalesce(current, F.concat_ws(":", "chrom", F.col("pos").cast("string"))))


def ids_to_markers(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """B15 inverse: ``chrom:pos`` -> (chrom, pos) marker list."""
    parts = F.split(F.col(id_col), ":")
    return ids.select(
        *[c for c in ids.columns if c not in ("chrom", "pos")],
        parts.getItem(0).alias("chrom"),
        parts.getItem(1).cast("bigint").alias("pos"),
    )


# --------------------------------------------------------------------- B16
def ancestor_bed(geno: DataFrame, strains: list[str] | None = None) -> DataFrame:
    """Translated genotype as BED (chrom, pos-1, end, first allele base);
    one strain (the ancestor) or every strain when ``strains`` is None."""
    df = geno if strains is None else geno.filter(F.col("strain").isin(strains))
    bases = G.allele_bases("ref", "alt")
    first = F.split(F.col("gt"), "[/|]").getItem(0)
    allele = F.when(first == F.lit("."), F.lit(".")).otherwise(F.element_at(bases, first.cast("int") + 1))
    return df.select(
        "strain",
        "chrom",
        (F.col("pos") - 1).alias("start"),
        (F.col("pos") + F.length("ref") - 1).alias("end"),
        allele.alias("allele"),
    )


# --------------------------------------------------------------------- B17
def interval_annotate(
    sites: DataFrame,
    intervals: DataFrame,
    value_col: str,
    name: str | None = None,
    key: str = "site_id",
) -> DataFrame:
    """Add the value of the overlapping annotation interval to each site.

    Intervals are 0-based half-open ``start_pos, end_pos``; a site spans
    ``[pos-1, pos-1+len(ref))``.  Equi-join on nested bins, so a contig-long
    interval takes a few rows and no nested-loop join is planned.
    ``op = self``: the value of the overlapping interval (first by start if
    several), plus the number of overlaps.  Left outer: unmatched sites stay.
    """
    name = name or value_col
    s = sites.select(key, F.col("chrom").alias("_schrom"), "pos", F.length("ref").alias("_ref"))
    iv = intervals.select(
        F.col("chrom").alias("_ichrom"),
        F.col("start_pos").alias("_i0"),
        F.col("end_pos").alias("_i1"),
        F.col(value_col).alias("_val"),
    )
    start = F.col("pos") - 1
    hits = B.overlap_join(s, iv, ("_schrom", start, start + F.col("_ref")), ("_ichrom", F.col("_i0"), F.col("_i1")))
    per_site = hits.groupBy(key).agg(
        F.min_by("_val", F.struct("_i0", "_val")).alias(name), F.count(F.lit(1)).alias(f"{name}_n")
    )
    return sites.join(per_site, key, "left").withColumn(f"{name}_n", F.coalesce(F.col(f"{name}_n"), F.lit(0).cast("bigint")))


# --------------------------------------------------------------------- B18
def drop_flagged(df: DataFrame, token: str = "Masked", cols: list[str] | None = None) -> DataFrame:
    """Keep rows whose text (all columns joined) does not contain ``token``."""
    cols = cols or df.columns
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.filter(~line.contains(token))


# --------------------------------------------------------------------- B19
def singletons(geno: DataFrame) -> DataFrame:
    """Alleles carried once (``S``, true singleton) or twice by one
    strain that is homozygous for it (``D``, private doubleton)."""
    a = geno.select("chrom", "pos", "strain", F.explode(G.alleles("gt")).alias("allele")).filter(
        F.col("allele").isNotNull()
    )
    per = a.groupBy("chrom", "pos", "allele").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("strain").alias("n_strains"),
        F.max("strain").alias("strain"),
    )
    return per.filter((F.col("n") == 1) | ((F.col("n") == 2) & (F.col("n_strains") == 1))).select(
        "chrom",
        "pos",
        F.when(F.col("n") == 1, F.lit("S")).otherwise(F.lit("D")).alias("singleton_type"),
        "allele",
        "strain",
        F.concat_ws(":", "chrom", F.col("pos").cast("string")).alias("id"),
    )


# --------------------------------------------------------------------- B20
def site_dosage_arrays(geno: DataFrame) -> DataFrame:
    """Per site: dosages by sample index (sorted names), NULL = missing call or
    no call row.  One group per site, bounded by the number of samples."""
    strains = list_samples(geno).select("strain", (F.col("sample_idx") - 1).cast("int").alias("sidx"))
    n = strains.agg(F.count(F.lit(1))).scalar()
    d = geno.select("site_id", "chrom", "pos", "strain", G.dosage("gt").alias("d")).join(strains, "strain")
    per_site = d.groupBy("site_id", "chrom", "pos").agg(F.collect_list(F.struct("sidx", "d")).alias("_e"))
    return per_site.withColumn("_n", n.cast("int")).select(
        "site_id", "chrom", "pos", G.dense("_e", "_n", "d", F.lit(None).cast("int")).alias("dos")
    )


def site_ranks(geno: DataFrame) -> DataFrame:
    """Dosage arrays with the site's 1-based rank along its chromosome
    (distributed block ranking, see ``functions.ranking``)."""
    arr = site_dosage_arrays(geno)
    ranks = block_rank(arr.select("site_id", "chrom", "pos"), "chrom", "pos", "rank", tiebreak="site_id")
    return arr.join(ranks.select("site_id", "rank"), "site_id")


def ld_r2(geno: DataFrame, window: int = LD_WINDOW) -> DataFrame:
    """B20 on the genotype table (see ``ld_r2_ranked``)."""
    return ld_r2_ranked(site_ranks(geno), window)


_PAIRS = "chrom string, site1 long, pos1 long, site2 long, pos2 long, r2 double"
_EDGES = "chrom string, a long, b long, r2 double, maf1 double, maf2 double"


def _block_r2(window: int, above: float | None, edges: bool = False):
    """r^2 of the pairs whose first site is in one block, over pairwise-complete
    calls: six products of the block's rows with all rows sent to it.  Rows are
    pairs of sites or, with ``edges``, of ranks with their minor allele frequency."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", ignore_index=True)
        g = np.array(pdf["dos"].tolist(), dtype=np.float64)  # -1 = missing
        called = (g >= 0).astype(np.float64)
        x = np.where(g >= 0, g, 0.0)
        own = np.flatnonzero(pdf["own"].to_numpy())
        rank = pdf["rank"].to_numpy()
        maf = _maf(x.sum(axis=1), 2 * called.sum(axis=1)) if edges else None
        empty = ["chrom", "a", "b", "r2", "maf1", "maf2"] if edges else ["chrom", "site1", "pos1", "site2", "pos2", "r2"]
        out = []
        for at in range(0, len(own), 512):  # rows of products held at a time
            i = own[at : at + 512]
            hi = np.searchsorted(rank, rank[i[-1]] + window)
            j = np.arange(i[0], hi)
            c1, x1, c2, x2 = called[i], x[i], called[j], x[j]
            n, sx, sy, sxy = c1 @ c2.T, x1 @ c2.T, c1 @ x2.T, x1 @ x2.T
            vx, vy = n * ((x1 * x1) @ c2.T) - sx * sx, n * (c1 @ (x2 * x2).T) - sy * sy
            near = (rank[j][None, :] > rank[i][:, None]) & (rank[j][None, :] < rank[i][:, None] + window)
            with np.errstate(divide="ignore", invalid="ignore"):
                cov = n * sxy - sx * sy
                r2 = np.where((vx > 0) & (vy > 0), cov * cov / (vx * vy), np.nan)
            keep = near if above is None else near & (r2 > above)
            a, b = np.nonzero(keep)
            if edges:
                ends = {"a": rank[i[a]], "b": rank[j[b]], "r2": r2[a, b], "maf1": maf[i[a]], "maf2": maf[j[b]]}
                out.append(pd.DataFrame({"chrom": pdf["chrom"].iloc[0], **ends}))
                continue
            out.append(
                pd.DataFrame(
                    {
                        "chrom": pdf["chrom"].iloc[0],
                        "site1": pdf["site_id"].to_numpy()[i[a]],
                        "pos1": pdf["pos"].to_numpy()[i[a]],
                        "site2": pdf["site_id"].to_numpy()[j[b]],
                        "pos2": pdf["pos"].to_numpy()[j[b]],
                        "r2": [None if v != v else v for v in r2[a, b]],
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=empty)

    return run


def _maf(alt: np.ndarray, called: np.ndarray) -> np.ndarray:
    """Minor allele frequency from ALT and called allele counts; 0 without calls."""
    p = alt / np.maximum(called, 1)
    return np.where(called > 0, np.minimum(p, 1 - p), 0.0)


def ld_r2_ranked(ranked: DataFrame, window: int = LD_WINDOW, above: float | None = None, block: int = 256) -> DataFrame:
    """r^2 of dosages for every pair of sites less than ``window``
    variants apart on a chromosome (plink window semantics); with ``above``
    only pairs over that value leave a task.

    Sites are cut into blocks of ranks, at least a window long.  A site goes
    to its own block and, as a right-hand site, to the block before it: two
    copies, whatever the window.  A block's pairs are matrix products.
    """
    return _by_rank_block(ranked, window, block, _block_r2(window, above), _PAIRS)


def ld_edges(ranked: DataFrame, window: int, above: float, block: int = 256) -> DataFrame:
    """The linked pairs of ``ld_r2_ranked`` as ranks a < b, with the minor allele
    frequency of both, for pruning."""
    return _by_rank_block(ranked, window, block, _block_r2(window, above, edges=True), _EDGES)


def _by_rank_block(ranked: DataFrame, window: int, block: int, run, schema: str) -> DataFrame:
    size = max(block, window)
    ship_package(ranked.sparkSession)
    b = F.floor((F.col("rank") - 1) / size).cast("bigint")
    dos = F.transform("dos", lambda d: F.coalesce(d, F.lit(-1)).cast("int"))
    copies = F.array(F.struct(b.alias("blk"), F.lit(True).alias("own")), F.struct((b - 1).alias("blk"), F.lit(False).alias("own")))
    rows = ranked.select("chrom", "site_id", "pos", "rank", dos.alias("dos"), F.explode(copies).alias("c"))
    rows = rows.select("chrom", "site_id", "pos", "rank", "dos", "c.blk", "c.own").filter("blk >= 0")
    return rows.groupBy("chrom", "blk").applyInPandas(run, schema)


# --------------------------------------------------------------------- B21
def ld_prune_sweep(
    geno: DataFrame,
    thresholds: list[float],
    window: int = LD_WINDOW,
    step: int = LD_STEP,
    victim: str = "maf",
    block: int | None = None,
) -> DataFrame:
    """B21 for several r^2 thresholds at once (the threshold is a grouping
    column, G9).  plink-style greedy pruning: windows of ``window`` variants
    start every ``step`` variants; inside a window, pairs are visited in rank
    order and for a pair with r^2 > threshold whose sites are both still
    kept, the lower-MAF site is removed (tie: the later one); with
    ``victim='later'`` the later site is always removed, which with
    ``step=1`` is the forward filter "drop a marker linked to an earlier
    kept marker within the window".

    A pair that no window holds is not visited.  Only edges above the threshold
    reach the greedy step, which works on blocks of windows
    (``operators.pruning``), however far linkage reaches.
    Returns the kept sites (``prune.in``) per threshold.
    """
    # ranked feeds the pairs and the result: one computation for both
    ship_package(geno.sparkSession)
    ranked = materialize(site_ranks(geno))
    called = F.aggregate(F.transform("dos", lambda d: F.when(d.isNull(), 0).otherwise(2)), F.lit(0), lambda a, b: a + b)
    alt = F.aggregate(F.transform("dos", lambda d: F.coalesce(d, F.lit(0))), F.lit(0), lambda a, b: a + b)
    p = alt / called
    maf = F.when(called > 0, F.least(p, 1 - p)).otherwise(F.lit(0.0))
    if victim == "later" and step == 1 and len(thresholds) == 1:  # most pairs may be linked: compare with kept sites only
        dos = F.transform("dos", lambda d: F.coalesce(d, F.lit(-1)).cast("int"))
        kept = forward_kept(ranked.select("chrom", "rank", dos.alias("dos")), window, thresholds[0], block)
        sites = ranked.select("site_id", "chrom", "pos", "rank", maf.alias("maf")).join(kept, ["chrom", "rank"], "left_semi")
        return sites.select(F.lit(float(thresholds[0])).alias("ld"), "site_id", "chrom", "pos", "maf")
    ts = F.array(*[F.lit(float(t)) for t in thresholds])
    edges = ld_edges(ranked, window, min(thresholds)).withColumn("ld", F.explode(ts)).filter(F.col("r2") > F.col("ld"))
    loser = F.col("b") if victim == "later" else F.when(F.col("maf1") >= F.col("maf2"), F.col("b")).otherwise(F.col("a"))
    removed = greedy_removals(edges.withColumn("victim", loser), window, step, block)
    sites = ranked.select("site_id", "chrom", "pos", "rank", maf.alias("maf")).withColumn("ld", F.explode(ts))
    return sites.join(removed, ["ld", "chrom", "rank"], "left_anti").select("ld", "site_id", "chrom", "pos", "maf")


def ld_prune(
    geno: DataFrame, threshold: float, window: int = LD_WINDOW, step: int = LD_STEP, victim: str = "maf"
) -> DataFrame:
    """Kept sites (``prune.in``) at one r^2 threshold."""
    return ld_prune_sweep(geno, [threshold], window, step, victim).drop("ld")


# --------------------------------------------------------------------- B22
def recode_dosage(geno: DataFrame) -> DataFrame:
    """Plink ``--recode 12`` coding (1 = minor allele, 2 = major, 0 =
    missing; the ALT is minor on a tie) and the 0/1/2 ALT dosage.
    Biallelic sites; the site's allele counts come from a site window."""
    a = G.alleles("gt")
    w = Window.partitionBy(*SITE)
    alt_n = F.sum(F.size(F.filter(a, lambda x: x == 1))).over(w)
    ref_n = F.sum(F.size(F.filter(a, lambda x: x == 0))).over(w)
    df = geno.withColumn("_alt_minor", alt_n <= ref_n).withColumn("_a", a)
    code = lambda x: F.when(x.isNull(), F.lit(0)).when((x == 1) == F.col("_alt_minor"), F.lit(1)).otherwise(F.lit(2))
    return df.select(
        "site_id",
        "strain",
        F.array_join(F.transform("_a", code), " ").alias("code12"),
        G.dosage("gt").alias("dosage"),
    )


# --------------------------------------------------------------------- B23
def marker_table(sites: DataFrame) -> DataFrame:
    """SNP table (chrom renamed I..V -> 1..5, X unchanged; id, cM 0, bp,
    A1, A2)."""
    m = F.create_map(*[F.lit(x) for kv in MARKER_CHROM_NAMES.items() for x in kv])
    return sites.select(
        F.coalesce(F.element_at(m, F.col("chrom")), F.col("chrom")).alias("chrom"),
        F.concat_ws(":", "chrom", F.col("pos").cast("string")).alias("id"),
        F.lit(0).alias("cm"),
        F.col("pos").alias("bp"),
        F.col("alt").alias("a1"),
        F.col("ref").alias("a2"),
    )


def individual_table(strains: DataFrame) -> DataFrame:
    """Individual table rows ``(1, id, 0, 0, sex 0, 1)``."""
    return strains.select(
        F.lit(1).alias("family"), F.col("strain").alias("id"), F.lit(0).alias("father"),
        F.lit(0).alias("mother"), F.lit(0).alias("sex"), F.lit(1).alias("status"),
    )
