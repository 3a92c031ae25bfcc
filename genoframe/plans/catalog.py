"""Registry of queries: name -> (Spark plan builder, oracle SQL or None).

A Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables.  The oracle is DuckDB SQL written independently of the Spark
plan, with the fixture views inlined as ``WITH`` clauses.  ``None`` marks an
operator that SQL cannot express (greedy pruning, eigen solvers, seeded
random choice); those are checked by invariants in ``tests/`` instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    group: str


_REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None, group: str) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, oracle, group)
        return fn

    return deco


def _load_all() -> None:
    # Import for the side effect of registration.
    from . import divergent_q  # noqa: F401
    from . import variants_q  # noqa: F401
    from . import intervals_q  # noqa: F401
    from . import haplotypes_q  # noqa: F401
    from . import alignment_q  # noqa: F401
    from . import pca_q  # noqa: F401
    from . import io_q  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load_all()  # imports are idempotent; never trust a partially filled registry
    return dict(_REGISTRY)
