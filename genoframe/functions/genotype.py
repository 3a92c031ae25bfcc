"""Genotype column expressions (all built-in functions, no Python UDFs).

A call ``gt`` is a VCF GT string: allele indexes separated by ``/`` or ``|``,
``.`` for a missing allele.  Sites carry ``ref`` and a comma-separated ``alt``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def alleles(gt: Column | str = "gt") -> Column:
    """ARRAY<INT> of allele indexes; NULL elements for missing alleles."""
    return F.transform(
        F.split(_c(gt), "[/|]"),
        lambda a: F.when(a == F.lit("."), F.lit(None).cast("int")).otherwise(a.cast("int")),
    )


def called_alleles(gt: Column | str = "gt") -> Column:
    """Number of called (non-missing) alleles of the call."""
    return F.size(F.filter(alleles(gt), lambda a: a.isNotNull()))


def nonref_alleles(gt: Column | str = "gt") -> Column:
    """Number of called alleles that are not the reference."""
    return F.size(F.filter(alleles(gt), lambda a: a > 0))


def is_missing(gt: Column | str = "gt") -> Column:
    """True if any allele of the call is missing (plink / N_MISSING sense)."""
    return F.exists(alleles(gt), lambda a: a.isNull())


def is_wholly_missing(gt: Column | str = "gt") -> Column:
    """A call starting with ``.`` is wholly missing (alignment sense)."""
    return F.substring(_c(gt), 1, 1) == F.lit(".")


def has_alt(gt: Column | str = "gt") -> Column:
    return F.exists(alleles(gt), lambda a: a > 0)


def dosage(gt: Column | str = "gt") -> Column:
    """Count of non-reference alleles; NULL if any allele is missing."""
    return F.when(is_missing(gt), F.lit(None).cast("int")).otherwise(nonref_alleles(gt))


def alt_list(alt: Column | str = "alt") -> Column:
    """ARRAY<STRING> of ALT alleles (``.`` means none)."""
    return F.when(_c(alt) == F.lit("."), F.array().cast("array<string>")).otherwise(F.split(_c(alt), ","))


def allele_bases(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """ARRAY<STRING>: REF followed by the ALT alleles (index = allele number)."""
    return F.concat(F.array(_c(ref)), alt_list(alt))


def dense(entries: Column | str, n: Column | str, value: str, default: Column) -> Column:
    """Array of ``n`` values from (``sidx``, value) entries, one per sample index.

    A site with a row for every sample (what a VCF gives) only needs a sort;
    absent samples are looked up, missing ones get ``default``."""
    full = F.transform(F.array_sort(_c(entries)), lambda e: F.coalesce(e[value], default))
    lookup = F.map_from_entries(_c(entries))
    sparse = F.transform(F.sequence(F.lit(0), _c(n) - 1), lambda i: F.coalesce(F.element_at(lookup, i), default))
    return F.when(F.size(_c(entries)) == _c(n), full).otherwise(sparse)


def is_snp_site(ref: Column | str = "ref", alt: Column | str = "alt", mode: str = "all") -> Column:
    """REF is one base and every (``all``) / some (``any``) ALT is one base."""
    one = lambda x: F.length(x) == F.lit(1)
    alts = alt_list(alt)
    pred = F.forall(alts, one) if mode == "all" else F.exists(alts, one)
    return (F.length(_c(ref)) == F.lit(1)) & pred & (F.size(alts) > 0)
