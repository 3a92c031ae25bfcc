"""Bounded bitmaps of key hashes: a filter without false negatives.

A set of 64-bit hashes is folded into ``2 ** log_bits`` bits, kept as rows
(``slot``, ``bits``) of 64 bits each.  However many keys there are, the table
has at most ``2 ** (log_bits - 6)`` rows of two longs, so it may always be
broadcast.  A key whose bit is not set is certainly not in the set; the others
go on to an exact join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^22 bits: at most 65,536 rows of two longs, about 1 MB, to every task.
LOG_BITS = 22


def _place(key: Column, log_bits: int) -> Column:
    return key.bitwiseAND(F.lit((1 << log_bits) - 1))


def bitmap(keys: DataFrame, key: str, log_bits: int = LOG_BITS) -> DataFrame:
    """(slot, bits) of the longs in the column ``key``."""
    place = _place(F.col(key), log_bits)
    bit = F.expr("shiftleft(1L, cast(_at & 63L as int))")
    return (
        keys.select(place.alias("_at"))
        .groupBy(F.shiftright("_at", 6).alias("slot"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def marked(rows: DataFrame, key: Column, filled: DataFrame, flag: str, log_bits: int = LOG_BITS) -> DataFrame:
    """``rows`` with a boolean ``flag``: whether the bit of ``key`` is set in the
    stored bitmap ``filled``.  A broadcast join on the slot; no row moves."""
    place = _place(key, log_bits)
    slots = F.broadcast(filled.select(F.col("slot").alias("_slot"), F.col("bits").alias("_bits")))
    joined = rows.withColumn("_place", place).join(slots, F.shiftright("_place", 6) == F.col("_slot"), "left")
    bit = F.getbit(F.coalesce("_bits", F.lit(0).cast("bigint")), F.col("_place").bitwiseAND(F.lit(63)).cast("int"))
    return joined.withColumn(flag, bit == 1).drop("_place", "_slot", "_bits")


def as_array(filled: DataFrame, log_bits: int) -> np.ndarray:
    """The bitmap as ``2 ** (log_bits - 6)`` words, for steps in Python."""
    out = np.zeros(1 << (log_bits - 6), np.uint64)
    rows = filled.select("slot", "bits").toArrow()
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def test(bitmap_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` have their bit set."""
    place = keys & np.uint64(len(bitmap_words) * 64 - 1)
    return (bitmap_words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
