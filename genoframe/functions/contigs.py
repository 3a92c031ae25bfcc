"""Contig (chromosome) order and naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six nuclear contigs, in genome order.
NUCLEAR_CONTIGS = ["I", "II", "III", "IV", "V", "X"]

# Roman -> integer chromosome names of the marker table (X stays X).
MARKER_CHROM_NAMES = {"I": "1", "II": "2", "III": "3", "IV": "4", "V": "5"}

UNKNOWN_RANK = 99


def contig_rank(chrom: Column | str, contigs: list[str] | None = None) -> Column:
    """0-based rank of a contig in genome order; unknown contigs rank last."""
    contigs = contigs or NUCLEAR_CONTIGS
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    expr = F.lit(UNKNOWN_RANK)
    for i, name in reversed(list(enumerate(contigs))):
        expr = F.when(c == F.lit(name), F.lit(i)).otherwise(expr)
    return expr


def contig_rank_sql(col: str, contigs: list[str] | None = None) -> str:
    contigs = contigs or NUCLEAR_CONTIGS
    whens = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(contigs))
    return f"CASE {col} {whens} ELSE {UNKNOWN_RANK} END"
