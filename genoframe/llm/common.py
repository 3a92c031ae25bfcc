"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.session import stored

from . import bits

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A stored table of at most this many bytes may be broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """Null text counts as empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII text, and
    much faster than ``translate``; other text takes ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fold(column: str, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def _bytes(field: T.StructField) -> Column:
    """About how many bytes a value takes in memory."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        size = 16 + F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        size = 16 + 16 * F.size(column) + F.octet_length(F.array_join(column, ""))
    elif isinstance(kind, T.ArrayType):
        size = 16 + 24 * F.size(column)
    else:
        size = F.lit(16)
    return F.coalesce(size, F.lit(16)).cast("long")


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the stored table ``df`` takes at most ``limit`` bytes, as measured."""
    total = df.agg(F.coalesce(F.sum(sum((_bytes(f) for f in df.schema.fields), F.lit(0))), F.lit(0))).first()[0]
    return total <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it :func:`is_small`, else unchanged, so
    that Spark joins it by shuffle."""
    return F.broadcast(df) if is_small(df, limit) else df


def frequent(counts: DataFrame, limit: int, column: str = "n") -> DataFrame:
    """The rows of the highest counts, ``limit`` at most, without a sort: counts
    fall into at most 512 classes, eight to a doubling, and the highest whole
    classes that fit are taken.  If the very highest does not fit, a share of it
    is taken by a hash of the row (a little under ``limit``)."""
    place = F.floor(8 * F.log2(column)).cast("int")
    sizes = dict(counts.groupBy(place.alias("place")).agg(F.count("*")).collect())
    taken, lowest = 0, None
    for p in sorted(sizes, reverse=True):
        taken += sizes[p]
        if taken > limit:
            break
        lowest = p
    if lowest is not None or not sizes:
        return counts.limit(0) if lowest is None else counts.filter(place >= lowest)
    share = max(0.0, limit - 4 * limit**0.5) / sizes[max(sizes)]
    drawn = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in counts.columns]), F.lit(1 << 30)) < int(share * (1 << 30))
    return counts.filter((place == max(sizes)) & drawn)


def keyed(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(``_doc``, ``_h``, ``_text``): the id, a 64-bit hash of the text and the
    text.  Rows that repeat an id stay apart unless their text repeats too."""
    return docs.select(
        F.col(doc).cast("long").alias("_doc"), F.xxhash64(text_of(text)).alias("_h"), text_of(text).alias("_text")
    )


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """(``row``, *keys): whole rows as one struct beside the given keys, so that
    no column of ``docs`` can clash with a key or with a joined table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])


def parted(rows: DataFrame, h: str, found: DataFrame, found_h: str, tag: str) -> tuple[DataFrame, DataFrame]:
    """(certain, possible): the rows whose text hash ``h`` is certainly not among
    ``found_h`` of the stored table ``found``, and the others.  The certain ones
    need no join: a bitmap of fixed size tells them apart, so that texts are only
    shuffled where they may meet a partner."""
    filled = stored(bits.bitmap(found, found_h), tag)
    flagged = bits.marked(rows, F.col(h), filled, "_possible")
    return flagged.filter("NOT _possible").drop("_possible"), flagged.filter("_possible").drop("_possible")


def without(docs: DataFrame, gone: DataFrame, text: str, doc: str) -> DataFrame:
    """The rows of ``docs`` whose (id, text hash) is not in the stored ``gone`` (_doc, _h)."""
    rows = packed(docs, key=F.col(doc), h=F.xxhash64(text_of(text)))
    certain, possible = parted(rows, "h", gone, "_h", "gone-bits")
    same = F.col("key").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h"))
    return certain.select("row.*").union(possible.join(gone, same, "left_anti").select("row.*"))
