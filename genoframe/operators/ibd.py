"""Pairwise IBD segments (inventory E1, E2), re-aimed from the published model.

Per marker, with p the ALT frequency over called alleles and q = 1 - p, a
pair of genotypes (ALT dosages g1, g2) has probability P_ibd under one shared
haplotype and P_null = HWE(g1) HWE(g2) without sharing; with
eps = min(0.25 MAF, 0.001) the marker's score is
L = log10(((1 - eps) P_ibd + eps P_null) / P_null).  Scores are fixed-point
integers (1e-6 LOD units), so every sum below is exact in any order.

Along a chromosome a pair runs the CUSUM D_i = max(0, D_{i-1} + L_i)
(D = S - min(0, running min S)).  A *fall* (D_{i-1} + L_i < 0) starts a new
excursion; an excursion's segment runs from its first marker after the fall
to its first maximum of D, and is kept if that maximum is >= 3 LOD.  Markers
where either call is missing are skipped for that pair.

Distributed plan (no per-site pair rows, no chromosome-wide task):

1. markers are ranked along the chromosome (block rank) and cut into chunks;
   each chunk is replicated once per block of strain pairs;
2. pass A (``applyInPandas`` per chunk x pair block, numpy): each pair's
   chunk summary (T, A) of the max-plus map D -> max(A, D + T);
3. the D entering every chunk is a running sum / running max over the small
   (pair, chunk) table: D_start(k) = CT(k-1) + max(0, max_{j<k} (A_j - CT_j));
4. pass C (cogroup of markers and D_start): exact rescan of each chunk,
   emitting excursion pieces (only pieces that can matter);
5. pieces are stitched into excursions with a window over chunks and a
   ``groupBy``; the LOD filter keeps the segments.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import genotype as G
from ..functions.ranking import block_rank
from ..session import materialize, ship_package

# Ibdseq settings of the reference (minalleles, ibdlod).
MIN_ALLELES = 4
IBD_LOD = 3.0
SCALE = 1_000_000  # fixed-point resolution of the scores (1e-6 LOD)
ERR_MAF_FACTOR = 0.25
ERR_MAX = 0.001
CHUNK = 4096  # markers per chunk
PAIR_BLOCK = 2048  # strain pairs per task


# --------------------------------------------------------------------- E1
def ibd_markers(geno: DataFrame, min_alleles: int = MIN_ALLELES) -> DataFrame:
    """Markers for IBD: one ALT, calls with a missing allele dropped, at
    least ``min_alleles`` copies of the minor allele.  One row per site with
    p (ALT frequency over called alleles)."""
    calls = geno.filter(~F.col("alt").contains(",") & ~G.is_missing("gt"))
    per_site = calls.groupBy("site_id", "chrom", "pos").agg(
        F.sum(G.nonref_alleles("gt")).alias("ac"), F.sum(G.called_alleles("gt")).alias("an")
    )
    mac = F.least(F.col("ac"), F.col("an") - F.col("ac"))
    return per_site.filter(mac >= F.lit(min_alleles)).withColumn("p", F.col("ac") / F.col("an")).withColumn(
        "maf", mac / F.col("an")
    )


# Ibdseq marker LD filter (r2max, r2window).
R2_MAX = 0.3
R2_WINDOW = 1500


def ibd_marker_ld_filter(
    geno: DataFrame, min_alleles: int = MIN_ALLELES, r2max: float = R2_MAX, window: int = R2_WINDOW
) -> DataFrame:
    """E1 (LD part): among the IBD markers, in chromosome order, drop a marker
    whose r^2 with an earlier kept marker less than ``window`` markers away
    exceeds ``r2max``.  B20/B21 with other parameters: windows start at every
    marker and the later marker of a linked pair is the one removed."""
    from . import variants as V

    markers = ibd_markers(geno, min_alleles).select("site_id")
    g = geno.filter(~F.col("alt").contains(",")).join(markers, "site_id", "left_semi")
    return V.ld_prune(g, r2max, window=window, step=1, victim="later")


def _score_table(p, maf) -> F.Column:
    """ARRAY<BIGINT> of the 9 fixed-point scores, index 3 * g1 + g2."""
    q = 1 - p
    eps = F.least(F.lit(ERR_MAF_FACTOR) * maf, F.lit(ERR_MAX))
    hw = [q * q, 2 * p * q, p * p]
    ibd = [
        [q * q * q, q * q * p, F.lit(0.0)],
        [q * q * p, p * q, p * p * q],
        [F.lit(0.0), p * p * q, p * p * p],
    ]
    vals = []
    for g1 in range(3):
        for g2 in range(3):
            null = hw[g1] * hw[g2]
            lr = ((1 - eps) * ibd[g1][g2] + eps * null) / null
            vals.append(F.round(F.log10(lr) * SCALE).cast("bigint"))
    return F.array(*vals)


def marker_table(
    geno: DataFrame, min_alleles: int = MIN_ALLELES, r2max: float | None = None, window: int = R2_WINDOW
) -> tuple[DataFrame, DataFrame]:
    """Markers with rank, score table and dosage array (sorted strain order,
    -1 = not called), plus the strain index table; with ``r2max`` only the
    markers that the LD filter keeps."""
    mk = ibd_markers(geno, min_alleles)
    if r2max is not None:
        mk = mk.join(ibd_marker_ld_filter(geno, min_alleles, r2max, window).select("site_id"), "site_id", "left_semi")
    strains = geno.select("strain").dropDuplicates()
    strains = strains.withColumn("sidx", (F.row_number().over(Window.orderBy("strain")) - 1).cast("int"))
    calls = geno.select("site_id", "strain", F.coalesce(G.dosage("gt"), F.lit(-1)).alias("d"))
    calls = calls.join(strains, "strain")
    n = strains.agg(F.count(F.lit(1))).scalar()
    dos = calls.groupBy("site_id").agg(F.collect_list(F.struct("sidx", "d")).alias("_e"))
    dos = dos.withColumn("_n", n.cast("int")).select("site_id", G.dense("_e", "_n", "d", F.lit(-1)).alias("dos"))
    ranked = block_rank(mk.select("site_id", "chrom", "pos", "p", "maf"), "chrom", "pos", "idx", tiebreak="site_id")
    ranked = ranked.withColumn("scores", _score_table(F.col("p"), F.col("maf")))
    return ranked.join(dos, "site_id"), strains


_SUMMARY = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("pblock", T.LongType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("t", T.LongType()),
        T.StructField("a", T.LongType()),
    ]
)

_PIECES = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("fall_idx", T.LongType()),
        T.StructField("carried", T.BooleanType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("part_max", T.LongType()),
        T.StructField("part_arg", T.LongType()),
        T.StructField("part_first", T.LongType()),
    ]
)


def _pairs_of_block(n: int, block: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    ii, jj = np.triu_indices(n, 1)
    return ii[block * size : (block + 1) * size], jj[block * size : (block + 1) * size]


def _chunk_scores(pdf: pd.DataFrame, pair_block: int):
    pdf = pdf.sort_values("idx")
    geno = np.array(pdf["dos"].tolist(), dtype=np.int64)  # m x n
    scores = np.array(pdf["scores"].tolist(), dtype=np.int64)  # m x 9
    block = int(pdf["pblock"].iloc[0])
    ii, jj = _pairs_of_block(geno.shape[1], block, pair_block)
    g1, g2 = geno[:, ii], geno[:, jj]
    valid = (g1 >= 0) & (g2 >= 0)
    code = np.where(valid, g1 * 3 + g2, 0)
    lod = np.where(valid, np.take_along_axis(scores, code, axis=1), 0)
    return pdf, ii, jj, valid, lod


def _pass_a(pair_block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, ii, jj, _, lod = _chunk_scores(pdf, pair_block)
        total = lod.sum(axis=0)
        if lod.shape[0] >= 2:
            suffix = np.cumsum(lod[::-1], axis=0)[:-1]  # proper suffix sums, lengths 1..m-1
            a = np.maximum(suffix.max(axis=0), 0)
        else:
            a = np.zeros(lod.shape[1], dtype=np.int64)
        return pd.DataFrame(
            {
                "chrom": pdf["chrom"].iloc[0],
                "chunk": int(pdf["chunk"].iloc[0]),
                "pblock": int(pdf["pblock"].iloc[0]),
                "i": ii.astype(np.int32),
                "j": jj.astype(np.int32),
                "t": total,
                "a": a,
            }
        )

    return run


def _pass_c(pair_block: int, keep: int):
    def run(mk: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if mk.empty:
            return pd.DataFrame({f.name: [] for f in _PIECES.fields})
        mk, ii, jj, valid, lod = _chunk_scores(mk, pair_block)
        idx = mk["idx"].to_numpy(dtype=np.int64)
        chunk = int(mk["chunk"].iloc[0])
        st = start.set_index(["i", "j"])["d_start"]
        d = st.reindex(list(zip(ii.tolist(), jj.tolist()))).fillna(0).to_numpy(dtype=np.int64)
        npair = len(ii)
        first_chunk = chunk == 0
        fall_idx = np.full(npair, 0 if first_chunk else -1, dtype=np.int64)
        carried = np.full(npair, not first_chunk)
        cur_max = np.full(npair, -1, dtype=np.int64)
        cur_arg = np.full(npair, -1, dtype=np.int64)
        cur_first = np.full(npair, -1, dtype=np.int64)
        out: list[tuple] = []

        def emit(mask: np.ndarray, last: bool) -> None:
            sel = np.nonzero(mask)[0]
            if sel.size:
                out.append(
                    (sel, fall_idx[sel].copy(), carried[sel].copy(), cur_max[sel].copy(), cur_arg[sel].copy(), cur_first[sel].copy(), last)
                )

        for r in range(lod.shape[0]):
            v = valid[r]
            nd = d + lod[r]
            fall = v & (nd < 0)
            if fall.any():
                emit(fall & (carried | (cur_max >= keep)), False)
                fall_idx[fall] = idx[r]
                carried[fall] = False
                cur_max[fall] = 0
                cur_arg[fall] = idx[r]
                cur_first[fall] = -1
            d = np.where(v, np.maximum(nd, 0), d)
            step = v & ~fall
            unset = step & (cur_first < 0)
            cur_first[unset] = idx[r]
            better = step & (d > cur_max)
            cur_max[better] = d[better]
            cur_arg[better] = idx[r]
        emit(np.ones(npair, dtype=bool), True)
        frames = []
        for sel, fi, ca, mx, ar, fs, last in out:
            frames.append(
                pd.DataFrame(
                    {
                        "chrom": mk["chrom"].iloc[0],
                        "chunk": chunk,
                        "i": ii[sel].astype(np.int32),
                        "j": jj[sel].astype(np.int32),
                        "fall_idx": np.where(ca, None, fi).astype(object),
                        "carried": ca,
                        "last": last,
                        "part_max": mx,
                        "part_arg": np.where(ar < 0, None, ar).astype(object),
                        "part_first": np.where(fs < 0, None, fs).astype(object),
                    }
                )
            )
        res = pd.concat(frames, ignore_index=True)
        for c in ("fall_idx", "part_arg", "part_first"):
            res[c] = pd.array(res[c], dtype="Int64")
        return res

    return run


def ibd_segments(
    geno: DataFrame,
    min_alleles: int = MIN_ALLELES,
    lod: float = IBD_LOD,
    chunk: int = CHUNK,
    pair_block: int = PAIR_BLOCK,
    r2max: float | None = None,
    r2window: int = R2_WINDOW,
) -> DataFrame:
    """IBD segments ``strain1, ind1, strain2, ind2, chrom, start_pos,
    stop_pos, lod`` (strain1 < strain2), one per excursion with peak >= lod.
    With ``r2max`` (the reference's command has 0.3) over E1's LD filter."""
    ship_package(geno.sparkSession)
    markers, strains = marker_table(geno, min_alleles, r2max, r2window)
    # pass A, pass C and the position lookup all read the marker table:
    # materialise it once (one row per marker, arrays of n dosages)
    markers = materialize(markers)
    n = strains.agg(F.count(F.lit(1))).scalar()
    n_blocks = F.ceil((n * (n - 1) / 2) / F.lit(pair_block)).cast("bigint")
    keep = int(round(lod * SCALE))
    mk = markers.withColumn("chunk", F.floor((F.col("idx") - 1) / chunk).cast("bigint")).withColumn(
        "pblock", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(n_blocks, F.lit(1)) - 1))
    )
    cols = ["chrom", "chunk", "pblock", "idx", "scores", "dos"]
    mk = mk.select(*cols)
    summary = mk.groupBy("chrom", "chunk", "pblock").applyInPandas(_pass_a(pair_block), _SUMMARY)
    w = Window.partitionBy("chrom", "i", "j").orderBy("chunk")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ct = F.sum("t").over(upto)
    summary = summary.withColumn("_ct", ct).withColumn("_x", F.col("a") - F.col("_ct"))
    starts = summary.withColumn(
        "d_start",
        F.when(
            F.col("chunk") == 0,
            F.lit(0).cast("bigint"),
        ).otherwise((F.col("_ct") - F.col("t")) + F.greatest(F.lit(0).cast("bigint"), F.max("_x").over(before))),
    ).select("chrom", "chunk", "pblock", "i", "j", "d_start")
    pieces = (
        mk.groupBy("chrom", "chunk", "pblock")
        .cogroup(starts.groupBy("chrom", "chunk", "pblock"))
        .applyInPandas(_pass_c(pair_block, keep), _PIECES)
    )
    # Excursion of the carried piece: the last fall in an earlier chunk.
    last_fall = F.when(F.col("last") & ~F.col("carried"), F.col("fall_idx"))
    lf = pieces.filter(F.col("last")).select("chrom", "i", "j", "chunk", last_fall.alias("_lf"))
    lf = lf.withColumn("_prev_fall", F.coalesce(F.last("_lf", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
    pieces = pieces.join(lf.select("chrom", "i", "j", "chunk", "_prev_fall"), ["chrom", "i", "j", "chunk"])
    pieces = pieces.withColumn("exc", F.coalesce(F.col("fall_idx"), F.col("_prev_fall")))
    exc = pieces.groupBy("chrom", "i", "j", "exc").agg(
        F.max("part_max").alias("peak"),
        F.min_by("part_arg", F.struct(-F.col("part_max"), F.col("part_arg"))).alias("stop_idx"),
        F.min("part_first").alias("start_idx"),
    )
    seg = exc.filter(F.col("peak") >= F.lit(keep))
    pos = markers.select("chrom", "idx", "pos")
    seg = (
        seg.join(pos.select("chrom", F.col("idx").alias("start_idx"), F.col("pos").alias("start_pos")), ["chrom", "start_idx"])
        .join(pos.select("chrom", F.col("idx").alias("stop_idx"), F.col("pos").alias("stop_pos")), ["chrom", "stop_idx"])
    )
    s1 = strains.select(F.col("sidx").alias("i"), F.col("strain").alias("strain1"))
    s2 = strains.select(F.col("sidx").alias("j"), F.col("strain").alias("strain2"))
    seg = seg.join(s1, "i").join(s2, "j")
    return seg.select(
        "strain1",
        F.lit(1).alias("ind1"),
        "strain2",
        F.lit(1).alias("ind2"),
        "chrom",
        "start_pos",
        "stop_pos",
        (F.col("peak") / F.lit(float(SCALE))).alias("lod"),
    )
