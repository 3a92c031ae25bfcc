"""Interval operators (inventory C, and A4 bin generation).

Range predicates are never left to a nested-loop join: overlaps are equi-joins
on nested bins (``functions.bins``).  The bin grids of C1-C3 come from at most
three rows per interval, however many bins it covers: where it starts and ends,
and where the run of wholly covered bins begins and stops; and one for each
border between blocks of ``BLOCK_BINS`` bins that this run crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins as B
from ..functions import genotype as G

BIN_SIZE = 1000
BLOCK_BINS = 16_384  # bins of a contig that the gap fill treats at once
MOST_TASKS = 8_192


# --------------------------------------------------------------------- A4
def make_bins(lengths: DataFrame, size: int = BIN_SIZE, length_col: str = "chrom_length") -> DataFrame:
    """A4: fixed bins over each chromosome, BED 0-based half-open; the last
    bin ends at the chromosome length."""
    return lengths.select(
        "chrom", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(length_col).cast("bigint") - 1, F.lit(size).cast("bigint"))).alias("start_bin"), F.col(length_col).alias("_len")
    ).select("chrom", "start_bin", F.least(F.col("start_bin") + size, F.col("_len")).alias("end_bin"))


def _block(b: Column) -> Column:
    """Block of a bin number; what lies before the contig belongs to the first one."""
    return F.greatest(F.floor(b / BLOCK_BINS), F.lit(0)).cast("bigint")


def _n_bins(length: Column, size: int) -> Column:
    return F.ceil(length / F.lit(size)).cast("bigint")


def _gap_fill(sparse: DataFrame, values: list[str], lengths: DataFrame, size: int, length_col: str) -> DataFrame:
    """Dense bins from sparse rows ``strain, chrom, _b`` (a row without values
    registers the block that begins at ``_b``) with, for every value ``v``, an
    amount ``v`` for that bin alone and a change ``v_run`` that holds from that
    bin to the end of its block.

    Ordered by bin within (strain, chrom, block), each sparse row generates its
    own bin and the bins up to the next sparse row, so every output row is
    produced exactly once: linear work, and only the sparse rows are shuffled.
    A window partition and a generated array hold at most one block, however
    long the contig is.  The blocks are dealt to as many tasks as a strain has
    blocks: few shuffled bytes may make many bins."""
    lens = lengths.select("chrom", F.col(length_col).cast("bigint").alias("_len"))
    zero = F.lit(0).cast("bigint")
    w = Window.partitionBy("strain", "chrom", "_blk").orderBy("_b")
    sums = [F.coalesce(F.sum(c), zero).cast("bigint").alias(c) for v in values for c in (v, f"{v}_run")]
    df = sparse.groupBy("strain", "chrom", _block(F.col("_b")).alias("_blk"), "_b").agg(*sums).join(lens, "chrom")
    tasks = -(-(lens.agg(F.sum(_n_bins(F.col("_len"), size))).first()[0] or 0) // BLOCK_BINS)
    df = df.repartition(min(max(tasks, 1), MOST_TASKS), "strain", "chrom", "_blk")
    df = df.withColumns({f"{v}_run": F.sum(f"{v}_run").over(w) for v in values}).withColumn("_next", F.lead("_b").over(w))
    n_bins = _n_bins(F.col("_len"), size)
    lo = F.greatest("_b", zero)
    hi = F.least(F.coalesce(F.col("_next"), (F.col("_blk") + 1) * BLOCK_BINS), n_bins) - 1
    seq = F.when(n_bins.isNotNull() & (hi >= lo), F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    gen = df.withColumn("_i", F.explode(seq))
    start = (F.col("_i") * size).cast("bigint")
    at = lambda v: F.col(f"{v}_run") + F.when(F.col("_i") == F.col("_b"), F.col(v)).otherwise(zero)
    return gen.select(
        "strain",
        "chrom",
        start.alias("start_bin"),
        F.least(start + size, F.col("_len")).alias("end_bin"),
        *[at(v).cast("bigint").alias(v) for v in values],
    )


def _registered(
    sparse: DataFrame, data: DataFrame, strains: DataFrame | None, lengths: DataFrame, size: int, length_col: str
) -> DataFrame:
    """``sparse`` plus a row for every block of every contig and every strain of
    the sample list (default: of ``data``), so that strains and contigs without
    data get bins.  Pairs (strain, contig) of ``sparse`` that are not on a given
    list get their blocks as well."""
    blocks = F.ceil(_n_bins(F.col(length_col), size) / BLOCK_BINS).cast("bigint")
    known = lengths.filter(F.col("chrom").isNotNull() & (blocks > 0)).select("chrom", blocks.alias("blocks"))
    contigs = known.agg(F.collect_set(F.struct("chrom", "blocks"))).scalar()  # a name and a number per contig
    every = (data if strains is None else strains).select("strain").distinct().select("strain", F.explode(contigs).alias("_c"))
    every = every.select("strain", "_c.chrom", "_c.blocks")
    if strains is not None:
        every = every.unionByName(sparse.select("strain", "chrom").distinct().join(known, "chrom"))
    # dealt by both columns: a union of two tables that are both dealt by strain counts as
    # dealt by strain, and the grouping above it would put a strain in one task
    every = every.repartition("strain", "chrom").select("strain", "chrom", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("_b"))
    every = every.withColumn("_b", F.col("_b") * BLOCK_BINS)
    return sparse.unionByName(every, allowMissingColumns=True)


def _change(b: Column, amount: Column, run: Column) -> Column:
    return F.struct(b.cast("bigint").alias("b"), amount.cast("bigint").alias("v"), run.cast("bigint").alias("run"))


def _held(changes: Column, first: Column, until: Column, run: Column) -> Column:
    """``changes``, of which ``run`` holds from bin ``first`` on until before bin
    ``until``, with one more for each block that begins in between or at the end:
    a change holds to the end of its block only."""
    blocks = F.when(_block(until) > _block(first), F.sequence(_block(first) + 1, _block(until)))
    again = F.transform(F.coalesce(blocks, F.array().cast("array<bigint>")), lambda k: _change(k * BLOCK_BINS, F.lit(0), run))
    return F.concat(changes, again)


def _changes(df: DataFrame, changes: Column, value: str) -> DataFrame:
    rows = df.select("strain", "chrom", F.explode(changes).alias("_c"))
    return rows.select("strain", "chrom", F.col("_c.b").alias("_b"), F.col("_c.v").alias(value), F.col("_c.run").alias(f"{value}_run"))


def _count_sparse(geno: DataFrame, size: int) -> DataFrame:
    """A call adds one to the only bin it touches, or one from its first bin on
    until after its last."""
    calls = geno.filter(G.has_alt("gt"))
    first = F.floor((F.col("pos") - 1) / size)
    last = F.floor((F.col("pos") - 2 + F.greatest(F.length("ref"), F.lit(1))) / size)
    zero, one = F.lit(0), F.lit(1)
    spread = _held(F.array(_change(first, zero, one), _change(last + 1, zero, -one)), first, last + 1, one)
    return _changes(calls, F.when(first == last, F.array(_change(first, one, zero))).otherwise(spread), "var_count")


def _depth_sparse(aligned: DataFrame, size: int) -> DataFrame:
    """An alignment adds its bases to its first and to its last bin, and the bin
    length from the bin after the first on until its last."""
    start, end, zero = F.col("start_pos"), F.col("end_pos"), F.lit(0)
    first, last = F.floor(start / size), F.floor((end - 1) / size)
    inner = F.when(last - first > 1, size).otherwise(0)
    spread = F.array(
        _change(first, (first + 1) * size - start, zero),
        _change(first + 1, zero, inner),
        _change(last, end - last * size, -inner),
    )
    spread = F.filter(_held(spread, first + 1, last, inner), lambda c: (c["v"] != 0) | (c["run"] != 0))
    one_bin = F.array(_change(first, end - start, zero))
    return _changes(aligned.filter(end > start), F.when(first == last, one_bin).otherwise(spread), "_bases")


def _depth(bases: str = "_bases") -> Column:
    return F.round(F.col(bases) * 100 / (F.col("end_bin") - F.col("start_bin")), 0) / 100


# --------------------------------------------------------------------- C1
def interval_count(
    geno: DataFrame,
    lengths: DataFrame,
    size: int = BIN_SIZE,
    length_col: str = "chrom_length",
    strains: DataFrame | None = None,
) -> DataFrame:
    """Per (strain, bin), the number of the strain's non-reference calls
    whose span [pos-1, pos-1+len(ref)) overlaps the bin; empty bins give 0.
    Every strain of ``strains`` (default: of the input) gets every contig."""
    sparse = _registered(_count_sparse(geno, size), geno, strains, lengths, size, length_col)
    return _gap_fill(sparse, ["var_count"], lengths, size, length_col)


# --------------------------------------------------------------------- C2
def interval_mean_depth(
    aligned: DataFrame,
    lengths: DataFrame,
    size: int = BIN_SIZE,
    length_col: str = "chrom_length",
    strains: DataFrame | None = None,
) -> DataFrame:
    """Mean read depth per (strain, bin) from aligned intervals
    ``start_pos, end_pos`` (0-based half-open): overlapping bases / bin
    length, 2 decimals (half up); bins without reads give 0, on every contig
    of every strain of ``strains`` (default: of the input)."""
    sparse = _registered(_depth_sparse(aligned, size), aligned, strains, lengths, size, length_col)
    filled = _gap_fill(sparse, ["_bases"], lengths, size, length_col)
    return filled.select("strain", "chrom", "start_bin", "end_bin", _depth().alias("coverage"))


def mask_from_calls(
    geno: DataFrame,
    aligned: DataFrame,
    lengths: DataFrame,
    size: int = BIN_SIZE,
    length_col: str = "chrom_length",
    strains: DataFrame | None = None,
) -> DataFrame:
    """C1 + C2 + C3 fused: the two sparse tables are added up by (strain, chrom,
    bin) and the dense mask of all contigs of the sample list (default: the
    strains with calls) is generated once by the gap fill."""
    names = (strains or geno).select("strain").distinct()
    sparse = _count_sparse(geno, size).unionByName(_depth_sparse(aligned, size), allowMissingColumns=True)
    sparse = _registered(sparse.join(names, "strain", "left_semi"), names, None, lengths, size, length_col)
    filled = _gap_fill(sparse, ["var_count", "_bases"], lengths, size, length_col)
    return filled.select("strain", "chrom", "start_bin", "end_bin", "var_count", _depth().alias("coverage"))


# --------------------------------------------------------------------- C3
def assemble_mask(counts: DataFrame, depth: DataFrame) -> DataFrame:
    """The mask table (strain, chrom, start_bin, end_bin, var_count,
    coverage).  A key join on the bin, not the reference's positional paste."""
    return counts.join(depth, ["strain", "chrom", "start_bin", "end_bin"], "inner").select(
        "strain", "chrom", "start_bin", "end_bin", "var_count", "coverage"
    )


# --------------------------------------------------------------------- C4
def interval_overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_cols: tuple[str, str, str] = ("chrom", "start_pos", "stop_pos"),
    right_cols: tuple[str, str, str] = ("chrom", "start_pos", "end_pos"),
) -> DataFrame:
    """C4: pairs of closed intervals that overlap (an endpoint of one lies
    within the other: ``a.start <= b.end AND b.start <= a.end``).

    Columns of ``right`` are prefixed ``r_``; chromosome columns are kept
    from ``left``."""
    lc, ls, le = left_cols
    rc, rs, re = (f"r_{c}" for c in right_cols)
    r = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    pairs = B.overlap_join(left, r, (lc, F.col(ls), F.col(le) + 1), (rc, F.col(rs), F.col(re) + 1))
    return pairs.drop(rc)
