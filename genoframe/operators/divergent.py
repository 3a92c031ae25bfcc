"""Hyper-divergent region calling per strain and over the population (inventory D).

Input: a mask table, one row per (strain, 1 kb bin) with the variant count and
mean read depth of the bin: ``strain, chrom, start_bin, end_bin, var_count,
coverage``.

Plan shape: the per-strain mean coverage and number of bins are stored
(one row per strain: bounded by the sample count), then one hash
shuffle on (strain, chrom), in as many partitions as the number of bins
asks for, feeds D3 and the cut of contigs into stretches that nothing of
D4-D9 reaches over (``segments``).  A second one on (strain, chrom, seg)
feeds all windows of D4-D9, which partition on these or a superset, so Spark
reuses that partitioning and only sorts within partitions.  Neighbours across
a chromosome boundary (D3 looks at the previous/next bin of the same strain)
come from a per-(strain, chrom) edge table of two values per chromosome, not
from a strain-wide window, so no task ever holds a whole strain.  Only the
population frequency (D8) needs another shuffle, on the bin key.

The regions alone (D10 / D17) need no bin after D3: they come from run lengths
(``_run_pieces``, ``_joined_runs``).  Their windows over bins see a block of a
contig, those over a contig see runs, so a cluster may be as long as a contig.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contigs import contig_rank
from ..session import materialize, stored

# Long-read optimised thresholds of the reference's calling.
COVERAGE_FRACTION = 0.35  # bins below this fraction of the strain's mean depth
VAR_COUNT_THRESHOLD = 15  # bins with more variants than this
CLUSTER_THRESHOLD = 9000  # minimum region size in bp
GAP_CLUSTER_THRESHOLD = 9000  # minimum size of clusters whose gaps are joined
GAP = 5000  # largest gap (bp) joined between two clusters
BIN_SIZE = 1000
BINS_PER_TASK = 100_000
BLOCK_BINS = 16_384  # bins of a contig that the run lengths see at once
BINS_PER_RUN_TASK = 400_000
GAP_FILL_BINS = 4  # only bins 1..4 after a joined cluster are filled
FREQ_RARE = 0.01
FREQ_INTERMEDIATE = 0.05

KEYS = ["strain", "chrom"]
SEG_KEYS = [*KEYS, "seg"]
BLOCK_KEYS = [*KEYS, "_blk"]


def _w_bins(keys: list[str] = KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy("start_bin")


def _w_bins_back(*ties: str, keys: list[str] = KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy(F.col("start_bin").desc(), *[F.col(c).desc() for c in ties])


# --------------------------------------------------------------------- D1
def strain_means(mask: DataFrame) -> DataFrame:
    """Mean coverage and number of bins of every strain."""
    return mask.groupBy("strain").agg(F.avg("coverage").alias("mean_cov_genome"), F.count(F.lit(1)).alias("bins"))


def coverage_fraction(mask: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Coverage divided by the strain's genome-wide mean coverage; 0 for a
    strain without any coverage.  The table of means (one row per strain) is
    joined without a hint: its measured size decides."""
    means = strain_means(mask) if means is None else means
    return mask.join(means.drop("bins"), "strain").withColumn(
        "fraction_cov", F.coalesce(F.try_divide("coverage", "mean_cov_genome"), F.lit(0.0))
    )


# --------------------------------------------------------------------- D2
def _window_id() -> Column:
    return F.concat_ws(" ", F.col("chrom"), F.col("start_bin").cast("string"), F.col("end_bin").cast("string"))


def classify_bins(
    cov: DataFrame, ct: int = VAR_COUNT_THRESHOLD, cov_fraction: float = COVERAGE_FRACTION
) -> DataFrame:
    """Count / LowCoverage flags, Pass or Divergent, window id."""
    return (
        cov.withColumn("is_count", F.col("var_count") > F.lit(ct))
        .withColumn("is_lowcov", F.col("fraction_cov") < F.lit(cov_fraction))
        .withColumn("window_id", _window_id())
        .withColumn(
            "div_class",
            F.when(F.col("is_count") | F.col("is_lowcov"), F.lit("Divergent")).otherwise(F.lit("Pass")),
        )
    )


# --------------------------------------------------------------------- D3
def _two_flank(is_pass: Column, prev_pass: Column, next_pass: Column) -> Column:
    return is_pass & ~prev_pass & ~next_pass


def _contig_edges(edges: DataFrame) -> DataFrame:
    """The outer neighbours of each contig's edge bins: the last / first bin of
    the adjacent contig of the same strain."""
    w = Window.partitionBy("strain").orderBy("_crank", "chrom")
    return edges.select(
        "strain",
        "chrom",
        F.lag("_last_pass").over(w).alias("_chrom_prev_pass"),
        F.lead("_first_pass").over(w).alias("_chrom_next_pass"),
    )


def two_flank_rescue(classified: DataFrame, contigs: list[str] | None = None) -> DataFrame:
    """D3: a Pass bin whose previous and next bin (same strain, genome order)
    are both not Pass becomes Divergent with reason ``TwoFlank``.  A missing
    neighbour counts as not Pass."""
    w = _w_bins()
    is_pass = F.col("div_class") == F.lit("Pass")
    df = (
        classified.withColumn("_crank", contig_rank("chrom", contigs))
        .withColumn("_prev_pass", F.lag(is_pass).over(w))
        .withColumn("_next_pass", F.lead(is_pass).over(w))
    )
    edges = df.groupBy("strain", "chrom", "_crank").agg(
        F.min_by(is_pass, F.col("start_bin")).alias("_first_pass"),
        F.max_by(is_pass, F.col("start_bin")).alias("_last_pass"),
    )
    df = df.join(_contig_edges(edges), KEYS, "left")  # two values per (strain, contig)
    prev_pass = F.coalesce(F.col("_prev_pass"), F.col("_chrom_prev_pass"), F.lit(False))
    next_pass = F.coalesce(F.col("_next_pass"), F.col("_chrom_next_pass"), F.lit(False))
    twoflank = _two_flank(is_pass, prev_pass, next_pass)
    return (
        df.withColumn("is_twoflank", twoflank)
        .withColumn(
            "div_id",
            F.concat(
                F.when(F.col("is_count"), F.lit("Count")).otherwise(F.lit("")),
                F.when(F.col("is_lowcov"), F.lit("LowCoverage")).otherwise(F.lit("")),
                F.when(F.col("is_twoflank"), F.lit("TwoFlank")).otherwise(F.lit("")),
            ),
        )
        .withColumn(
            "div_class",
            F.when(F.col("is_count") | F.col("is_lowcov") | F.col("is_twoflank"), F.lit("Divergent")).otherwise(
                F.lit("Pass")
            ),
        )
        .drop("_prev_pass", "_next_pass", "_chrom_prev_pass", "_chrom_next_pass", "_crank")
    )


# --------------------------------------------------------------------- D4 / D7
def _runs(df: DataFrame, keys: list[str]) -> DataFrame:
    """``cluster``, the bin's ``_row`` and ``_run``: first bin and row of its run."""
    w = _w_bins(keys)
    is_div = F.col("div_class") == F.lit("Divergent")
    df = df.withColumn(
        "cluster",
        is_div & (F.coalesce(F.lag(is_div).over(w), F.lit(False)) | F.coalesce(F.lead(is_div).over(w), F.lit(False))),
    )
    run_start = F.col("cluster") & ~F.coalesce(F.lag("cluster").over(w), F.lit(False)) & F.col("start_bin").isNotNull()
    df = df.withColumn("_row", F.row_number().over(w)).withColumn("_mark", F.when(run_start, F.struct("start_bin", "_row")))
    carry = F.last("_mark", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("_run", F.when(F.col("cluster"), carry)).drop("_mark")


def cluster_bins(df: DataFrame, bin_size: int = BIN_SIZE, keys: list[str] = KEYS) -> DataFrame:
    """D4 (and D7): gaps-and-islands over divergent bins per (strain, chrom).

    ``cluster``: divergent with a divergent neighbour.  ``cluster_start``: the
    first bin of the run (NULL for bins outside a run).  ``cluster_size``:
    run length x bin size; 1000 for an isolated divergent bin; NULL for Pass.
    """
    return _sized(_runs(df, keys), bin_size, keys)


def _sized(runs: DataFrame, bin_size: int, keys: list[str]) -> DataFrame:
    is_div = F.col("div_class") == F.lit("Divergent")
    df = runs.withColumn("cluster_start", F.col("_run.start_bin"))
    # the row that ends the run comes from the other direction, in the order that D5 needs
    back = _w_bins_back("_row", keys=keys)
    run_end = F.when(F.col("cluster") & ~F.coalesce(F.lag("cluster").over(back), F.lit(False)), F.col("_row"))
    last_row = F.last("_mark", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn("_mark", run_end)
    run_len = last_row - F.col("_run._row") + 1
    return (
        df.withColumn(
            "cluster_size",
            F.when(~is_div, F.lit(None).cast("bigint"))
            .when(F.col("cluster_start").isNull(), F.lit(bin_size).cast("bigint"))
            .otherwise((run_len * bin_size).cast("bigint")),
        )
        .drop("_mark", "_run", "_row")
        .withColumn("cluster_end", F.col("cluster_start") + F.col("cluster_size"))
    )


# --------------------------------------------------------------------- D5
def _next_big_cluster(df: DataFrame, threshold: int, keys: list[str] = KEYS) -> DataFrame:
    """For bins of clusters >= threshold: start and end of the next such
    cluster on the same strain and chromosome (a reverse running ``last``,
    O(n) per partition, no self-join)."""
    big = F.coalesce(F.col("cluster_size") >= F.lit(threshold), F.lit(False))
    first_row = big & (F.col("start_bin") == F.col("cluster_start"))
    after = _w_bins_back(keys=keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_big", big)
        .withColumn("_next_start", F.when(big, F.last(F.when(first_row, F.col("cluster_start")), ignorenulls=True).over(after)))
        .withColumn("_next_end", F.when(big, F.last(F.when(first_row, F.col("cluster_end")), ignorenulls=True).over(after)))
    )


def _gap_columns(df: DataFrame, gap: int) -> DataFrame:
    gap_size = F.col("_next_start") - F.col("cluster_end")
    joined = F.col("_big") & gap_size.isNotNull() & (gap_size > 0) & (gap_size <= F.lit(gap))
    return df.withColumn("gap_size", F.when(F.col("_big"), gap_size)).withColumn(
        "gap_join", F.coalesce(joined, F.lit(False))
    )


def cluster_gaps(
    clustered: DataFrame, threshold: int = GAP_CLUSTER_THRESHOLD, gap: int = GAP
) -> DataFrame:
    """One row per cluster >= threshold with the gap to the next cluster
    on the same strain and chromosome, whether it is joined, and the extended
    cluster (reference semantics: no next cluster -> extended end is NULL)."""
    df = _gap_columns(_next_big_cluster(clustered, threshold), gap)
    clusters = df.filter(F.col("_big") & (F.col("start_bin") == F.col("cluster_start"))).select(
        "strain",
        "chrom",
        "cluster_start",
        "cluster_size",
        "cluster_end",
        "gap_size",
        F.when(F.col("gap_join"), F.lit("join")).alias("gap_join"),
        F.when(F.col("gap_join"), F.col("_next_end"))
        .when(F.col("_next_start").isNotNull(), F.col("cluster_end"))
        .alias("extended_cluster_end"),
    )
    ext = Window.partitionBy("strain", "chrom", "extended_cluster_end")
    return clusters.withColumn("extended_cluster_start", F.min("cluster_start").over(ext)).withColumn(
        "extended_cluster_size", F.col("extended_cluster_end") - F.col("extended_cluster_start")
    )


# --------------------------------------------------------------------- D6
def fill_gaps(
    clustered: DataFrame,
    threshold: int = GAP_CLUSTER_THRESHOLD,
    gap: int = GAP,
    fill_bins: int = GAP_FILL_BINS,
    keys: list[str] = KEYS,
) -> DataFrame:
    """A non-divergent bin 1..4 bins after the end of a joined cluster
    becomes Divergent with div_id ``gap``.  A five-bin gap fills four bins."""
    w = _w_bins(keys)
    df = _gap_columns(_next_big_cluster(clustered, threshold, keys), gap)
    ends_joined = (F.col("end_bin") == F.col("cluster_end")) & F.col("gap_join")
    df = df.withColumn("_ends_joined", F.coalesce(ends_joined, F.lit(False)))
    hit = F.lit(False)
    for k in range(1, fill_bins + 1):
        hit = hit | F.coalesce(F.lag("_ends_joined", k).over(w), F.lit(False))
    is_div = F.col("div_class") == F.lit("Divergent")
    filled = ~is_div & hit
    return (
        df.withColumn("div_id", F.when(filled, F.lit("gap")).otherwise(F.col("div_id")))
        .withColumn("div_class", F.when(filled, F.lit("Divergent")).otherwise(F.col("div_class")))
        .drop("_ends_joined", "_big", "_next_start", "_next_end", "gap_size", "gap_join")
    )


# --------------------------------------------------------------------- D1-D7
_BIN_COLS = [
    "strain",
    "chrom",
    "start_bin",
    "end_bin",
    "var_count",
    "coverage",
    "fraction_cov",
    "div_class",
    "div_id",
]


def segments(
    flagged: DataFrame, bin_size: int = BIN_SIZE, gap: int = GAP, fill_bins: int = GAP_FILL_BINS, apart: int = 1024
) -> DataFrame:
    """Number the stretches (``seg``) of a contig that D4-D7 can treat on their own.

    A stretch may begin at a bin with more than ``fill_bins`` bins between it and
    the last divergent one, and more than ``gap`` bp beyond the end of every
    cluster so far: no run, joined gap or filled bin reaches over such a place.
    It begins at a divergent bin, or at every ``apart``-th one if none is.  The
    columns of ``_runs`` are kept: no run is cut."""
    w = _w_bins()
    upto, before = (w.rowsBetween(Window.unboundedPreceding, at) for at in (Window.currentRow, -1))
    is_div = F.col("div_class") == F.lit("Divergent")
    end = F.col("_run.start_bin") + (F.col("_row") - F.col("_run._row") + 1) * bin_size
    df = _runs(flagged, KEYS)
    last_div = F.max(F.when(is_div, F.col("_row"))).over(before)
    df = df.withColumn("_far", F.coalesce(F.col("_row") - last_div > fill_bins + 1, F.lit(True)))
    df = df.withColumn("_end", F.max(end).over(before))
    clear = F.col("_end").isNull() | F.coalesce(F.col("start_bin") - F.col("_end") > gap, F.lit(False))
    cut = F.col("_far") & clear & (is_div | (F.col("_row") % apart == 0))
    return df.withColumn("seg", F.sum(cut.cast("int")).over(upto)).drop("_far", "_end")


def gap_joined_clusters(mask: DataFrame, contigs: list[str] | None = None) -> DataFrame:
    """Every bin with its final class, reason and cluster, and the stretch
    ``seg`` of its contig that holds all of the cluster.

    The bins are dealt to tasks by their number, not by shuffled bytes: a bin
    takes a few compressed bytes in a shuffle and far more in a sort.  Only the
    one sort of D3 sees a whole contig; the others see stretches of it."""
    return _joined_and_tasks(mask, contigs)[0]


def _joined_and_tasks(mask: DataFrame, contigs: list[str] | None = None) -> tuple[DataFrame, int]:
    """``gap_joined_clusters`` and the number of tasks that its bins ask for."""
    means = stored(strain_means(mask), "strain-means")  # one row per strain
    tasks = max(1, -(-(means.agg(F.sum("bins")).first()[0] or 0) // BINS_PER_TASK))
    cov = coverage_fraction(mask, means).repartition(tasks, *KEYS)
    flagged = segments(two_flank_rescue(classify_bins(cov), contigs).select(*_BIN_COLS)).repartition(tasks, *SEG_KEYS)
    first = _sized(flagged, BIN_SIZE, SEG_KEYS)
    filled = fill_gaps(first, keys=SEG_KEYS).select(*_BIN_COLS, "seg")
    return cluster_bins(filled, keys=SEG_KEYS), tasks


def _with_final_flags(reclustered: DataFrame, threshold: int = CLUSTER_THRESHOLD) -> DataFrame:
    """D9 flags inside the (strain, chrom, seg) partitioning: ``is_big`` for bins
    of clusters >= threshold and ``is_final`` for those not dropped as
    deletions (no Count / CountLowCoverage bin in the cluster)."""
    big = F.coalesce(F.col("cluster_size") >= F.lit(threshold), F.lit(False))
    is_count = F.col("div_id").isin("Count", "CountLowCoverage").cast("int")
    per_cluster = Window.partitionBy(*SEG_KEYS, "cluster_start")
    return (
        reclustered.withColumn("is_big", big)
        .withColumn("is_count", is_count)
        .withColumn(
            "flag_del",
            F.when(big, F.when(F.max(is_count).over(per_cluster) == 0, F.lit("Del")).otherwise(F.lit("Pass"))),
        )
        .withColumn("is_final", big & F.coalesce(F.col("flag_del") == F.lit("Pass"), F.lit(False)))
    )


def strain_count(mask: DataFrame) -> DataFrame:
    """Number of strains (mask files) as a one-row DataFrame."""
    return mask.agg(F.countDistinct("strain").alias("strain_count"))


def freq_bin(freq: Column, rare: float = FREQ_RARE, intermediate: float = FREQ_INTERMEDIATE) -> Column:
    return (
        F.when(freq < F.lit(rare), F.lit("Rare"))
        .when(freq < F.lit(intermediate), F.lit("Intermediate"))
        .otherwise(F.lit("Common"))
    )


# --------------------------------------------------------------------- D8 / D9
def divergent_bins(
    mask: DataFrame,
    threshold: int = CLUSTER_THRESHOLD,
    rare: float = FREQ_RARE,
    intermediate: float = FREQ_INTERMEDIATE,
    contigs: list[str] | None = None,
    keep_deletions: bool = False,
) -> DataFrame:
    """D8 + D9: bins of final divergent regions with population frequency.
    ``keep_deletions=True`` stops after D8 (deletion clusters still flagged).

    freq counts every strain with the bin inside a cluster >= threshold,
    deletion clusters included (frequency is computed before they drop).
    The strain count is a scalar subquery (its own small job), not a join.
    The shuffle on the bin key is dealt by the number of bins, as the ones before.
    """
    joined, tasks = _joined_and_tasks(mask, contigs)
    flagged = _with_final_flags(joined.filter(F.col("cluster_size") >= F.lit(threshold)), threshold)
    per_window = Window.partitionBy("chrom", "start_bin", "end_bin")
    n = strain_count(mask).scalar()
    df = (
        flagged.repartition(tasks, "chrom", "start_bin", "end_bin")
        .withColumn("_n_window", F.count(F.lit(1)).over(per_window))
        .withColumn("freq", F.col("_n_window") / n)
        .withColumn("mwf", F.when(F.col("freq") > 0.5, 1 - F.col("freq")).otherwise(F.col("freq")))
        .withColumn("freq_bin", freq_bin(F.col("freq"), rare, intermediate))
    )
    if not keep_deletions:
        df = df.filter(F.col("is_final"))
    return df.select(
        "strain",
        "chrom",
        "start_bin",
        "end_bin",
        _window_id().alias("window_id"),
        "var_count",
        "fraction_cov",
        "div_class",
        "div_id",
        "cluster_start",
        "cluster_size",
        "cluster_end",
        "freq",
        "mwf",
        "freq_bin",
        "is_count",
        "flag_del",
    )


# --------------------------------------------------------------------- D1-D9 by run lengths
def _run_pieces(mask: DataFrame, contigs: list[str] | None, threshold: int) -> DataFrame:
    """D1-D3, and the runs of bins of one class in each block of a contig.

    A row is a run of ``_n`` bins from the block's bin number ``_r0`` (of
    ``_in_blk``) on: whether it is divergent and holds a Count bin, its first start
    ``_s0`` and on how many bins, and the last four ends ``_ends``.  The outer bins
    of a block do not know their neighbour: a Pass bin there waits for D3 in
    ``_whole_runs``.  Runs at the borders are kept, and of the others the divergent
    ones that can be a cluster of ``threshold`` or be reached by the gap fill."""
    means = stored(strain_means(mask), "strain-means")  # one row per strain
    tasks = max(1, -(-(means.agg(F.sum("bins")).first()[0] or 0) // BINS_PER_RUN_TASK))
    block = F.coalesce(F.floor(F.col("start_bin") / (BIN_SIZE * BLOCK_BINS)), F.lit(0)).cast("bigint")
    df = classify_bins(coverage_fraction(mask, means)).select(
        *KEYS, block.alias("_blk"), "start_bin", "end_bin", F.coalesce("is_count", F.lit(False)).alias("_count"), (F.col("div_class") == "Pass").alias("_pass")
    )
    w = _w_bins(BLOCK_KEYS)
    # two bins on either side, and the ends of the three before
    around = {n: F.lag("_pass", k).over(w) for n, k in (("_a2", 2), ("_a1", 1), ("_b1", -1), ("_b2", -2))}
    ends = {f"_e{k}": F.lag("end_bin", k).over(w) for k in (1, 2, 3)}
    df = df.repartition(tasks, *BLOCK_KEYS).withColumns(around | ends | {"_row": F.row_number().over(w)})
    div = lambda prev, at, after: ~F.col(at) | F.coalesce(_two_flank(*map(F.col, (at, prev, after))), F.lit(False))
    df = df.withColumn("_div", div("_a1", "_pass", "_b1"))
    changes = lambda *bins: F.coalesce(div(*bins) != F.col("_div"), F.lit(True))
    df = df.withColumns({"_new": changes("_a2", "_a1", "_pass"), "_last": changes("_pass", "_b1", "_b2")})
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns(
        {"_run": F.sum(F.col("_new").cast("int")).over(upto), "_s0": F.last(F.when(F.col("_new"), F.col("start_bin")), ignorenulls=True).over(upto)}
    )
    runs = df.groupBy(*BLOCK_KEYS, "_run").agg(
        F.max("_div").alias("_div"),
        F.max("_count").alias("_count"),
        F.min("_row").cast("bigint").alias("_r0"),
        F.count(F.lit(1)).alias("_n"),
        F.max("_s0").alias("_s0"),
        F.count_if(F.col("start_bin") == F.col("_s0")).alias("_at_s0"),
        *[F.max(F.when(F.col("_last"), F.col(c))).alias(c) for c in ("end_bin", *ends)],
    )
    wb = Window.partitionBy(*BLOCK_KEYS).orderBy("_run")
    until = F.col("_r0") + F.col("_n") - 1
    runs = runs.withColumn("_until", until).withColumn("_in_blk", F.max("_until").over(Window.partitionBy(*BLOCK_KEYS)))
    large = F.col("_div") & (F.col("_n") * BIN_SIZE >= min(threshold, GAP_CLUSTER_THRESHOLD))
    runs = runs.withColumn("_keep", large | (F.col("_r0") <= 2) | (F.col("_until") >= F.col("_in_blk") - 1))
    reached = F.coalesce(F.max(F.when(F.col("_keep"), F.col("_until"))).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_reached", F.col("_r0") - reached <= GAP_FILL_BINS + 1)
    last_ends = F.array("_e3", "_e2", "_e1", "end_bin")
    size = F.least(F.col("_n"), F.lit(4)).cast("int")
    kept = runs.filter(F.col("_keep") | (F.col("_div") & F.col("_reached"))).select(
        *BLOCK_KEYS, "_div", "_count", "_r0", "_n", "_in_blk", "_s0", "_at_s0", F.slice(last_ends, -size, size).alias("_ends")
    )
    return stored(kept, "divergent-runs")


def _whole_runs(pieces: DataFrame, contigs: list[str] | None) -> DataFrame:
    """D3 at the borders of blocks, and the divergent runs (D4) of each contig:
    rows ``_first`` to ``_last`` of the contig, ``_n`` of them."""
    w = Window.partitionBy(*KEYS).orderBy("_blk", "_r0")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.struct("_blk", "_r0")
    edges = pieces.withColumn("_crank", contig_rank("chrom", contigs)).groupBy(*KEYS, "_crank").agg(
        F.min_by(~F.col("_div"), at).alias("_first_pass"), F.max_by(~F.col("_div"), at).alias("_last_pass")
    )
    df = pieces.join(_contig_edges(edges), KEYS, "left").withColumns(
        {
            "_prev_pass": ~F.lag("_div").over(w),
            "_next_pass": ~F.lead("_div").over(w),
            "_before": F.sum(F.when(F.col("_r0") == 1, F.col("_in_blk")).otherwise(0)).over(upto) - F.col("_in_blk"),
        }
    )
    until = F.col("_r0") + F.col("_n") - 1
    inside = F.lit(False)  # next to a single Pass bin, a bin of its block is not Pass
    prev_pass = F.when(F.col("_r0") > 1, inside).otherwise(F.coalesce("_prev_pass", "_chrom_prev_pass", F.lit(False)))
    next_pass = F.when(until < F.col("_in_blk"), inside).otherwise(F.coalesce("_next_pass", "_chrom_next_pass", F.lit(False)))
    waits = (F.col("_n") == 1) & ((F.col("_r0") == 1) | (until == F.col("_in_blk")))
    df = df.filter(F.col("_div") | (waits & _two_flank(~F.col("_div"), prev_pass, next_pass)))
    df = df.withColumns({"_first": F.col("_before") + F.col("_r0"), "_last": F.col("_before") + until})
    w = Window.partitionBy(*KEYS).orderBy("_first")
    df = df.withColumn("_new", F.coalesce(F.col("_first") != F.lag("_last").over(w) + 1, F.lit(True)))
    df = df.withColumn("_run", F.sum(F.col("_new").cast("int")).over(w))
    ends = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_first", "_ends"))), lambda x: x["_ends"]))
    return df.groupBy(*KEYS, "_run").agg(
        F.min_by("_s0", "_first").alias("_s0"),
        F.min_by("_at_s0", "_first").alias("_at_s0"),
        F.max("_count").alias("_count"),
        F.sum("_n").alias("_n"),
        F.max("_last").alias("_last"),
        ends.alias("_ends"),
        F.min("_first").alias("_first"),
    )


def _clustered(runs: DataFrame) -> DataFrame:
    """The run's ``cluster_start``, ``cluster_size`` and ``cluster_end`` as in D4;
    a single bin has no start."""
    size = F.when(F.col("cluster_start").isNull(), F.lit(BIN_SIZE)).otherwise(F.col("_n") * BIN_SIZE).cast("bigint")
    df = runs.withColumn("cluster_start", F.when(F.col("_n") > 1, F.col("_s0"))).withColumn("cluster_size", size)
    return df.withColumn("cluster_end", F.col("cluster_start") + F.col("cluster_size"))


def _joined_runs(runs: DataFrame) -> DataFrame:
    """D5-D7 on run lengths: the clusters of each contig after the gap fill.

    The Pass bins among the four after a joined cluster's end belong to it; where
    they reach the next run, the two are one cluster."""
    w = Window.partitionBy(*KEYS).orderBy("_first")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = _clustered(runs)
    big = F.col("cluster_start").isNotNull() & (F.col("cluster_size") >= GAP_CLUSTER_THRESHOLD)
    df = df.withColumn("_big", big)
    next_big = F.lead("cluster_start").over(Window.partitionBy(*KEYS, "_big").orderBy("_first"))
    df = df.withColumn("_next_start", F.when(F.col("_big"), next_big))
    df = _gap_columns(df, GAP)
    is_end = lambda k: F.get("_ends", F.size("_ends") - 1 - k) == F.col("cluster_end")
    end_row = F.coalesce(*[F.when(is_end(k), F.col("_last") - k) for k in range(GAP_FILL_BINS)])
    df = df.withColumn("_end_row", F.when(F.col("gap_join"), end_row))
    reach = F.coalesce(F.max("_end_row").over(upto) + GAP_FILL_BINS - F.col("_last"), F.lit(0))
    df = df.withColumns({"_reach": F.greatest(reach, F.lit(0)), "_apart": F.lead("_first").over(w) - F.col("_last") - 1})
    df = df.withColumn("_filled", F.least("_reach", "_apart"))
    df = df.withColumn("_new", ~F.coalesce(F.lag(F.col("_filled") >= F.col("_apart")).over(w), F.lit(False)))
    df = df.withColumn("_run", F.sum(F.col("_new").cast("int")).over(upto))
    return _clustered(
        df.groupBy(*KEYS, "_run").agg(
            F.min_by("_s0", "_first").alias("_s0"),
            F.min_by("_at_s0", "_first").alias("_at_s0"),
            F.max("_count").alias("_count"),
            F.sum(F.col("_n") + F.col("_filled")).alias("_n"),
        )
    )


# --------------------------------------------------------------------- D10 / D17
def divergent_regions(
    mask: DataFrame, threshold: int = CLUSTER_THRESHOLD, contigs: list[str] | None = None
) -> DataFrame:
    """D10 / D17 (flagship): distinct divergent regions per strain.

    One row per final cluster (D9: large enough and not a deletion), or one per
    bin that comes several times at its start; frequency does not filter regions.
    """
    clusters = _joined_runs(_whole_runs(_run_pieces(mask, contigs, threshold), contigs))
    final = F.col("cluster_start").isNotNull() & (F.col("cluster_size") >= threshold) & F.col("_count")
    return clusters.filter(final).select(
        "strain", "chrom", "cluster_start", "cluster_size", "cluster_end", F.explode(F.sequence(F.lit(1), "_at_s0")).alias("_i")
    ).drop("_i")


def region_bed(regions: DataFrame) -> DataFrame:
    """The regions as BED lines, numbered per strain by chrom and start."""
    line = F.row_number().over(Window.partitionBy("strain").orderBy("chrom", "cluster_start"))
    return regions.select(
        "chrom", F.col("cluster_start").alias("start_pos"), F.col("cluster_end").alias("end_pos"), "strain",
        line.cast("bigint").alias("bed_line"),
    )


# --------------------------------------------------------------------- D11
def total_divergent_size(final_bins: DataFrame) -> DataFrame:
    """Distinct divergent windows / 1e3, overall (``All``) and by freq_bin.
    freq_bin is a function of the window, so each distinct window is counted
    once under its class and once under ``All`` (one pass, no union)."""
    windows = final_bins.select("chrom", "start_bin", "end_bin", "mwf", "freq_bin").dropDuplicates()
    return (
        windows.select(F.explode(F.array("freq_bin", F.lit("All"))).alias("freq_bin"))
        .groupBy("freq_bin")
        .agg((F.count(F.lit(1)) / 1e3).alias("size_kb"))
    )


# --------------------------------------------------------------------- D12
def divergence_stats(mask: DataFrame, threshold: int = CLUSTER_THRESHOLD, contigs: list[str] | None = None) -> DataFrame:
    """Mean variant count and coverage fraction of divergent vs other bins,
    per class, per strain, per strain over divergent bins only, and the grand
    means of the per-strain tables.  One labelled table (``scope``).

    The bins are reduced once to sums and counts per (strain, class) - one
    row per strain and class - and every statistic is derived from that."""
    flagged = _with_final_flags(gap_joined_clusters(mask, contigs), threshold)
    cls = F.when(F.col("is_final"), F.lit("Divergent")).otherwise(F.lit("Pass"))
    part = materialize(
        flagged.groupBy("strain", cls.alias("div_class")).agg(
            F.sum("var_count").alias("_sc"), F.sum("fraction_cov").alias("_sf"), F.count(F.lit(1)).alias("_n")
        )
    )  # at most 2 rows per strain; five outputs read it, the window pipeline runs once
    mean = lambda df, *keys: df.groupBy(*keys).agg(
        (F.sum("_sc") / F.sum("_n")).alias("mean_count"), (F.sum("_sf") / F.sum("_n")).alias("mean_cov")
    )
    null = F.lit(None).cast("string")
    by_class = mean(part, "div_class").select(F.lit("class").alias("scope"), null.alias("strain"), "div_class", "mean_count", "mean_cov")
    per_strain = mean(part, "strain")
    per_strain_div = mean(part.filter(F.col("div_class") == "Divergent"), "strain")
    s1 = per_strain.select(F.lit("strain").alias("scope"), "strain", null.alias("div_class"), "mean_count", "mean_cov")
    s2 = per_strain_div.select(F.lit("strain_divergent").alias("scope"), "strain", F.lit("Divergent").alias("div_class"), "mean_count", "mean_cov")
    grand = lambda df, scope, c: df.agg(
        F.avg("mean_count").alias("mean_count"), F.avg("mean_cov").alias("mean_cov")
    ).select(F.lit(scope).alias("scope"), null.alias("strain"), c.alias("div_class"), "mean_count", "mean_cov")
    g1 = grand(per_strain, "grand", null)
    g2 = grand(per_strain_div, "grand_divergent", F.lit("Divergent"))
    return by_class.unionByName(s1).unionByName(s2).unionByName(g1).unionByName(g2)


# --------------------------------------------------------------------- D13
def strain_size(final_bins: DataFrame, strains: list[str] | None = None) -> DataFrame:
    """Divergent size (kb) of the named strains (all strains if None)."""
    df = final_bins if strains is None else final_bins.filter(F.col("strain").isin(strains))
    return df.groupBy("strain").agg((F.count(F.lit(1)) / 1e3).alias("size_kb"))


# --------------------------------------------------------------------- D14
def bins_by_class(final_bins: DataFrame) -> DataFrame:
    """Distinct divergent bins of each freq class and of all classes
    (each bin row tagged with its class and ``All``; one pass, no union)."""
    return final_bins.select(
        F.explode(F.array("freq_bin", F.lit("All"))).alias("class"), "chrom", "start_bin", "end_bin"
    ).dropDuplicates()


# --------------------------------------------------------------------- D15
def population_regions(final_bins: DataFrame) -> DataFrame:
    """Contiguous distinct bins of each class merged into regions.

    Islands by ``lag(end) != start``; the window is per (class, chrom) over
    distinct bins, so its size is bounded by the genome length / bin size,
    not by the number of strains or rows.
    """
    bins = bins_by_class(final_bins)
    w = Window.partitionBy("class", "chrom").orderBy("start_bin")
    new_island = F.coalesce(F.lag("end_bin").over(w) != F.col("start_bin"), F.lit(True)).cast("int")
    return (
        bins.withColumn("_island", F.sum(new_island).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("class", "chrom", "_island")
        .agg(F.min("start_bin").alias("start"), F.max("end_bin").alias("end"))
        .drop("_island")
    )


# --------------------------------------------------------------------- D16
def strain_order(regions: DataFrame) -> DataFrame:
    """Region size, total divergent size per strain, and the strain's
    rank by total (descending, ties by name).  The ranking window runs on the
    per-strain totals (one row per strain), not on the regions."""
    sized = regions.select(
        "chrom", F.col("cluster_start").alias("start"), F.col("cluster_end").alias("stop"), "strain"
    ).withColumn("size", F.col("stop") - F.col("start"))
    totals = sized.groupBy("strain").agg(F.sum("size").alias("total"))
    ranked = totals.withColumn(
        "strain_rank", F.row_number().over(Window.orderBy(F.col("total").desc(), F.col("strain"))).cast("bigint")
    )
    return sized.join(ranked, "strain")
