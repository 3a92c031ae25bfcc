"""Register the driver's tables and build the synthetic genomics views.

Spark side: ``fixture(spark, sf_dir, "f_mask")`` returns a DataFrame derived
from the parquet tables, so the work of every query grows with them.
Oracle side: ``with_fixtures(["f_mask"], body)`` inlines the same view text as
``WITH`` clauses in front of a DuckDB query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .fixture_sql import FIXTURE_SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Which fixture views read which other fixture views.
DEPENDS = {
    "f_geno": ["f_site"],
    "f_chrom": ["f_site"],
    "f_markers": ["f_site"],
    "f_annot": ["f_site"],
}

# Base tables each fixture reads.
BASE = {
    "f_site": ["part"],
    "f_geno": ["nation"],
    "f_mask": ["part", "nation"],
    "f_seg": ["part", "nation"],
    "f_align": ["lineitem"],
    "f_sheet": ["nation"],
    "f_rename": ["nation"],
    "f_eigen": ["nation"],
    "f_pc": ["nation"],
}


def _closure(names: list[str]) -> list[str]:
    """Fixture names with their dependencies, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


# Tables whose rows the views multiply (by strain), with the key they are spread by.
FANNED_OUT = {"part": "p_partkey"}
ROWS_PER_TASK = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in partitions of about ``ROWS_PER_TASK`` rows: a small file, which Spark
    reads in one task, may hold the rows of a large view.  The count is file metadata."""
    tasks = -(-df.count() // ROWS_PER_TASK)
    return df.repartition(tasks, key) if tasks > 1 else df


_REF = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(TABLES + list(FIXTURE_SQL)) + r")\b")


def _parameterised(sql: str) -> tuple[str, list[str]]:
    """The view text with its table references as ``{name}`` parameters."""
    names: list[str] = []

    def sub(m: re.Match) -> str:
        names.append(m.group(2))
        return f"{m.group(1)} {{{m.group(2)}}}"

    return _REF.sub(sub, sql), sorted(set(names))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture view ``name`` as a DataFrame over the tables in ``sf_dir``.

    Table references are bound as DataFrame parameters of ``spark.sql``, so
    no session-global view is created or replaced (safe when several queries
    are built concurrently in one session)."""
    built: dict[str, DataFrame] = {}
    for n in _closure([name]):
        text, refs = _parameterised(FIXTURE_SQL[n])
        args = {r: built[r] if r in built else table(spark, sf_dir, r) for r in refs}
        args |= {r: _spread(args[r], FANNED_OUT[r]) for r in refs if r in FANNED_OUT and r not in built}
        built[n] = spark.sql(text, **args)
    return built[name]


def with_fixtures(
    names: list[str], body: str, extra_ctes: list[tuple[str, str]] | None = None, recursive: bool = False
) -> str:
    """``WITH [RECURSIVE] <fixture views>, <extra ctes> <body>`` for the DuckDB oracle."""
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in _closure(names)]
    for n, sql in extra_ctes or []:
        parts.append(f"{n} AS ({sql.strip()})")
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()
