"""Shared haplotypes and selective sweeps from pairwise IBD segments (inventory E3-E22).

Segments: ``strain1, ind1, strain2, ind2, chrom, start_pos, stop_pos, lod``
(1-based closed).  Plan:

* E3: distinct breakpoints per chromosome, ranked by the distributed block
  rank; interval *i* = (breakpoint i, breakpoint i+1) by an equi-join on rank.
* E4: a segment covers the intervals whose rank lies in
  [rank(start), rank(stop) - 1]: two equi-joins and a generator, no range join.
* E5: connected components along the chromosome (``operators.connectivity``):
  segments enter blocks and tree nodes, never single intervals, and runs of
  intervals with an unchanged component come out.  The membership grid (every interval x every strain, the reference's
  membership matrix) is produced by exploding the sorted strain list, which
  is bounded by the number of samples; strains without an edge are
  singleton components.
* E6-E22: windows and aggregates; chromosome-level aggregates are
  ``groupBy`` + join, never a chromosome-wide window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contigs import NUCLEAR_CONTIGS
from ..functions.ranking import block_rank
from ..session import materialize
from .connectivity import component_runs

IV = ["chrom", "rank"]

# Sweep calling thresholds of the reference.
SWEEP_MIN_LENGTH = 1e6  # haplotype runs longer than this count towards a sweep
SWEEP_MIN_SHARE = 0.03  # share of the swept haplotype / ratio that flags a sweep
HIST_BINS = 30
HIST_LOG10_MAX = 6.0  # histogram limits 1 .. 1e6 on a log10 axis


# --------------------------------------------------------------------- E3
def breakpoints(seg: DataFrame) -> DataFrame:
    """Distinct segment endpoints per chromosome with their rank."""
    bps = (
        seg.select("chrom", F.col("start_pos").alias("bp"))
        .unionByName(seg.select("chrom", F.col("stop_pos").alias("bp")))
        .dropDuplicates()
    )
    return block_rank(bps, "chrom", "bp", "rank", block=100_000)


def breakpoint_intervals(seg: DataFrame, remove_small: bool = False, size: int = 0) -> DataFrame:
    """Consecutive breakpoints as intervals (start, stop), rank = rank of
    the start breakpoint; optionally drop intervals of length <= size."""
    bp = breakpoints(seg)
    nxt = bp.select("chrom", (F.col("rank") - 1).alias("rank"), F.col("bp").alias("stop"))
    iv = bp.join(nxt, IV).select("chrom", "rank", F.col("bp").alias("start"), "stop")
    if remove_small:
        iv = iv.filter(F.col("stop") - F.col("start") > F.lit(size))
    return iv


# --------------------------------------------------------------------- E4
def covered_ranks(seg: DataFrame) -> DataFrame:
    """Segments as ranks of the intervals they contain: ``chrom, strain1,
    strain2, lo, hi``."""
    bp = breakpoints(seg)
    return (
        seg.join(bp.select("chrom", F.col("bp").alias("start_pos"), F.col("rank").alias("lo")), ["chrom", "start_pos"])
        .join(bp.select("chrom", F.col("bp").alias("stop_pos"), (F.col("rank") - 1).alias("hi")), ["chrom", "stop_pos"])
        .filter(F.col("hi") >= F.col("lo"))
        .select("chrom", "strain1", "strain2", "lo", "hi")
    )


def segment_interval_join(seg: DataFrame, intervals: DataFrame | None = None) -> DataFrame:
    """Every (segment, interval it contains) pair as a strain-graph edge.
    The pairs are the result here; E5 does without them."""
    intervals = intervals if intervals is not None else breakpoint_intervals(seg)
    s = covered_ranks(seg).select("chrom", "strain1", "strain2", F.explode(F.sequence("lo", "hi")).alias("rank"))
    return s.join(intervals, IV).select("chrom", "rank", "start", "stop", "strain1", "strain2")


# --------------------------------------------------------------------- E5
def strain_universe(seg: DataFrame) -> DataFrame:
    """Strains that appear in at least one segment (the reference's universe)."""
    return seg.select(F.col("strain1").alias("strain")).unionByName(seg.select(F.col("strain2").alias("strain"))).dropDuplicates()


def haplotype_components(seg: DataFrame, strains: DataFrame | None = None) -> DataFrame:
    """E5: (chrom, rank, start, stop, strain, component) for every interval
    and every strain; component = smallest strain name in the connected
    component (a strain without an edge is its own component)."""
    intervals = breakpoint_intervals(seg)
    runs = component_runs(covered_ranks(seg))
    labels = runs.select("chrom", "strain", "component", F.explode(F.sequence("first", "last")).alias("rank"))
    universe = strains if strains is not None else strain_universe(seg)
    names = universe.agg(F.array_sort(F.collect_set("strain"))).scalar()
    grid = intervals.select("chrom", "rank", "start", "stop", F.explode(names).alias("strain"))
    grid = grid.join(labels, ["chrom", "rank", "strain"], "left").withColumn(
        "component", F.coalesce("component", "strain")
    )
    # Every downstream operator reads the grid several times: materialise it
    # once in the checkpoint folder instead of solving the components again.
    return materialize(grid)


# --------------------------------------------------------------------- E6 / E7 / E8
def haplotype_frequencies(grid: DataFrame) -> DataFrame:
    """Component size / number of strains, one row per component.  Every
    interval of the grid holds every strain, so n is the interval's row count."""
    sizes = grid.groupBy("chrom", "rank", "start", "stop", "component").agg(F.count(F.lit(1)).alias("_size"))
    n = F.sum("_size").over(Window.partitionBy("chrom", "rank"))
    return sizes.select("chrom", "start", "stop", "component", (F.col("_size") / n).alias("frequency"))


def haplotype_homozygosity(grid: DataFrame) -> DataFrame:
    """Sum over components of (size / n)^2 per interval."""
    freq = haplotype_frequencies(grid)
    return freq.groupBy("chrom", "start", "stop").agg(F.sum(F.col("frequency") * F.col("frequency")).alias("hh"))


def membership_matrix(grid: DataFrame) -> DataFrame:
    """One column per strain (pivot at the edge only)."""
    return grid.groupBy("chrom", "start", "stop").pivot("strain").agg(F.first("component"))


# --------------------------------------------------------------------- E9
def drop_singleton_haplotypes(grid: DataFrame) -> DataFrame:
    """A component of size 1 becomes NULL."""
    size = F.count(F.lit(1)).over(Window.partitionBy("chrom", "rank", "component"))
    return grid.withColumn("component", F.when(size > 1, F.col("component")))


# --------------------------------------------------------------------- E10
def sharing_rank(nosingle: DataFrame) -> DataFrame:
    """Per strain, sum over intervals of length x size of its (non-NULL)
    component; rank 1 = most sharing (ties by strain name).  The ranking
    window runs on one row per strain."""
    size = F.count(F.lit(1)).over(Window.partitionBy("chrom", "rank", "component"))
    contrib = nosingle.withColumn(
        "_c", F.when(F.col("component").isNotNull(), (F.col("stop") - F.col("start")) * size).otherwise(F.lit(0))
    )
    sim = contrib.groupBy("strain").agg(F.sum("_c").cast("bigint").alias("similarity"))
    return sim.withColumn(
        "strain_rank", F.row_number().over(Window.orderBy(F.col("similarity").desc(), F.col("strain"))).cast("bigint")
    )


# --------------------------------------------------------------------- E11
def name_haplotypes(nosingle: DataFrame, ranks: DataFrame) -> DataFrame:
    """Each component takes the name of its best-ranked member."""
    df = nosingle.join(ranks.select("strain", "strain_rank"), "strain")
    best = F.min_by("strain", "strain_rank").over(Window.partitionBy("chrom", "rank", "component"))
    return df.withColumn("haplotype", F.when(F.col("component").isNotNull(), best))


# --------------------------------------------------------------------- E12
def melt_haplotypes(named: DataFrame, ranks: DataFrame) -> DataFrame:
    """Long (chrom, start, stop, isotype, value) with plotpoint (rank of
    the isotype) and sat = 0.9 + 0.1 * (rank of the value mod 2)."""
    r = ranks.select(F.col("strain").alias("_v"), F.col("strain_rank").alias("_vr"))
    df = named.join(r, named["haplotype"] == r["_v"], "left")
    return df.select(
        "chrom",
        "rank",
        "start",
        "stop",
        F.col("strain").alias("isotype"),
        F.col("haplotype").alias("value"),
        F.col("strain_rank").alias("plotpoint"),
        (F.lit(0.9) + (F.col("_vr") % 2) * F.lit(0.1)).alias("sat"),
        F.col("_vr").alias("cvalue"),
    )


# --------------------------------------------------------------------- E13
def haplotype_counts(melted: DataFrame) -> DataFrame:
    """Rows per (chrom, start, stop, value), NULL value included."""
    return melted.groupBy("chrom", "start", "stop", "value").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- E15
def condense_runs(melted: DataFrame) -> DataFrame:
    """Per (chrom, isotype) in interval order, consecutive intervals with
    the same haplotype (NULL equals NULL) merge; ``segment`` numbers the runs
    (NULL runs counted); runs of NULL are then dropped."""
    w = Window.partitionBy("chrom", "isotype").orderBy("start", "stop")
    change = (
        F.when(F.row_number().over(w) == 1, 1)
        .when(F.lag("value").over(w).eqNullSafe(F.col("value")), 0)
        .otherwise(1)
    )
    df = melted.withColumn("segment", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    runs = df.groupBy("chrom", "isotype", "segment", "value", "plotpoint", "sat", "cvalue").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    return runs.filter(F.col("value").isNotNull()).select(
        "chrom",
        "start",
        "stop",
        F.col("value").alias("haplotype"),
        "isotype",
        "plotpoint",
        "sat",
        "segment",
        "cvalue",
        (F.col("stop") - F.col("start")).alias("hap_length"),
    )


# --------------------------------------------------------------------- E16 / E17
def swept_haplotype(runs: DataFrame) -> DataFrame:
    """Per chromosome, the haplotype with the largest summed run length
    (ties: smallest name for the name column)."""
    per_hap = runs.groupBy("chrom", "haplotype").agg(F.sum("hap_length").alias("chrom_haplotype_sum"))
    per_chrom = per_hap.groupBy("chrom").agg(
        F.max("chrom_haplotype_sum").alias("_max_sum"),
        F.min_by("haplotype", F.struct(-F.col("chrom_haplotype_sum"), F.col("haplotype"))).alias("swept_haplotype_name"),
    )
    isos = runs.groupBy("chrom").agg(F.countDistinct("isotype").alias("isotypes_w_haplotype"))
    df = (
        runs.join(per_hap, ["chrom", "haplotype"])
        .join(per_chrom, "chrom")
        .join(isos, "chrom")
        .withColumn("swept_haplotype", F.col("chrom_haplotype_sum") == F.col("_max_sum"))
        .drop("_max_sum")
    )
    has = df.groupBy("chrom", "isotype").agg(
        F.max((F.col("haplotype") == F.col("swept_haplotype_name")).cast("int")).cast("boolean").alias("isotype_has_swept_haplotype")
    )
    return df.join(has, ["chrom", "isotype"])


def sweep_metrics(swept: DataFrame, min_length: float = SWEEP_MIN_LENGTH, min_share: float = SWEEP_MIN_SHARE) -> DataFrame:
    """Swept length per isotype, its maximum per chromosome, the share,
    the filtered sweep length and ratio, and ``is_swept``; the swept flag is
    reset for isotypes that are not swept."""
    swept_len = F.when(F.col("swept_haplotype"), F.col("hap_length")).otherwise(F.lit(0))
    per_hi = swept.groupBy("chrom", "haplotype", "isotype").agg(F.sum(swept_len).alias("_hi_len"))
    per_iso = per_hi.groupBy("chrom", "isotype").agg(F.max("_hi_len").alias("isotype_swept_haplotype_length"))
    per_chrom = per_iso.groupBy("chrom").agg(F.max("isotype_swept_haplotype_length").alias("max_swept_haplotype_length"))
    df = (
        swept.join(per_iso, ["chrom", "isotype"])
        .join(per_chrom, "chrom")
        .withColumn("max_haplotype_shared", F.col("isotype_swept_haplotype_length") / F.col("max_swept_haplotype_length"))
    )
    df = df.withColumn(
        "filtered_swept_haplotype_len",
        F.when(
            (F.col("hap_length") > F.lit(min_length)) & (F.col("max_haplotype_shared") > F.lit(min_share)) & F.col("swept_haplotype"),
            F.col("hap_length"),
        ).otherwise(F.lit(0)).cast("bigint"),
    )
    filt = df.groupBy("chrom", "isotype").agg(F.sum("filtered_swept_haplotype_len").alias("filtered_sweep_len"))
    df = (
        df.join(filt, ["chrom", "isotype"])
        .withColumn("filtered_sweep_ratio", F.col("filtered_sweep_len") / F.col("max_swept_haplotype_length"))
        .withColumn("is_swept", F.col("filtered_sweep_ratio") > F.lit(min_share))
        .withColumn("swept_haplotype", F.when(~F.col("is_swept"), F.lit(False)).otherwise(F.col("swept_haplotype")))
    )
    return df


def plot_table(seg: DataFrame) -> DataFrame:
    """E5 -> E17 end to end: the reference's ``plot_df``."""
    grid = haplotype_components(seg)
    nosingle = drop_singleton_haplotypes(grid)
    ranks = sharing_rank(nosingle)
    melted = melt_haplotypes(name_haplotypes(nosingle, ranks), ranks)
    runs = materialize(condense_runs(melted))
    return sweep_metrics(swept_haplotype(runs))


# --------------------------------------------------------------------- E18-E22
def haplotype_output(plot_df: DataFrame) -> DataFrame:
    """The haplotype BED columns; cvalue (haplotype rank) keys the colour."""
    return plot_df.select("chrom", "start", "stop", "haplotype", "isotype", "plotpoint", "segment", "cvalue")


def sweep_summary(plot_df: DataFrame, contigs: list[str] | None = None) -> DataFrame:
    """Isotype x chromosome table of filtered_sweep_ratio."""
    d = plot_df.select("chrom", "isotype", "filtered_sweep_ratio").dropDuplicates()
    return d.groupBy("isotype").pivot("chrom", contigs or NUCLEAR_CONTIGS).agg(F.first("filtered_sweep_ratio"))


def haplotype_share(plot_df: DataFrame, contigs: list[str] | None = None) -> DataFrame:
    """Isotype x chromosome table of max_haplotype_shared (``_hapshare``
    suffix); is_swept NULL -> false in the long form."""
    d = plot_df.select(
        "chrom", "isotype", "max_haplotype_shared", F.coalesce("is_swept", F.lit(False)).alias("is_swept")
    ).dropDuplicates()
    contigs = contigs or NUCLEAR_CONTIGS
    wide = d.groupBy("isotype").pivot("chrom", contigs).agg(F.first("max_haplotype_shared"))
    return wide.select("isotype", *[F.col(c).alias(f"{c}_hapshare") for c in contigs])


def haplotype_length_histogram(plot_df: DataFrame, bins: int = HIST_BINS, log10_max: float = HIST_LOG10_MAX) -> DataFrame:
    """Histogram of log10(hap_length) over the axis limits [1, 1e6]:
    ``bins`` bins of width log10_max / (bins - 1) centred on multiples of the
    width, closed on the right; values outside the limits are dropped."""
    width = log10_max / (bins - 1)
    x = F.log10(F.col("hap_length").cast("double"))
    d = plot_df.filter((F.col("hap_length") >= 1) & (F.col("hap_length") <= F.lit(10**log10_max)))
    k = F.greatest(F.ceil(x / F.lit(width) - F.lit(0.5)), F.lit(0)).cast("bigint")
    h = d.select(k.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    return h.select(
        "bin",
        F.round((F.col("bin") - 0.5) * width, 6).alias("xmin_log10"),
        F.round((F.col("bin") + 0.5) * width, 6).alias("xmax_log10"),
        "count",
    )


def haplotype_plot_rects(plot_df: DataFrame) -> DataFrame:
    """Distinct plot rectangles (Mb on x, plotpoint +- 0.5 on y)."""
    return plot_df.select(
        "chrom",
        (F.col("start") / 1e6).alias("xmin"),
        (F.col("stop") / 1e6).alias("xmax"),
        (F.col("plotpoint") - 0.5).alias("ymin"),
        (F.col("plotpoint") + 0.5).alias("ymax"),
        F.col("haplotype").alias("fill"),
        F.col("swept_haplotype").alias("swept"),
    ).dropDuplicates()


def haplotype_plot_labels(plot_df: DataFrame) -> DataFrame:
    """Y-axis labels (plotpoint, isotype)."""
    return plot_df.select("plotpoint", "isotype").dropDuplicates()
