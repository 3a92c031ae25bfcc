"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is built and fully executed with a ``noop`` write (the whole plan
runs, nothing is collected to the driver); an untimed warm-up pass over the
same queries precedes the timed pass.  ``BENCH_QUERIES=all`` runs every registered query;
``BENCH_QUERIES=a,b`` runs a list.  ``BENCH_ROWS=1`` adds untimed row counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "divergent_regions",  # D17 flagship: mask -> regions
    "divergence_stats",  # D12
    "population_regions",  # D15
    "interval_count",  # C1: variant counts per strain x 1 kb bin
    "interval_mean_depth",  # C2: depth per strain x bin
    "isotype_variants",  # B1 -> B2 -> B4
    "site_counts",  # B3
    "merge_multiallelic",  # B9
    "ld_r2",  # B20
    "ld_prune",  # B21
    "ibd_segments",  # E2: pairwise IBD (distributed CUSUM)
    "sweep_metrics",  # E5 -> E17
    "alignment_by_strain",  # F6
    "pairwise_distance",  # F8
    "relatedness",  # G3
    "pca",  # G4
    "vcf_ingest",  # A1 round trip
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from genoframe.plans.catalog import all_queries
    from genoframe.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="genoframe-bench")
    qs = all_queries()
    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(qs) if sel == "all" else ([s for s in sel.split(",") if s] or HEADLINE)
    names = [n for n in names if n in qs]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm-up pass (untimed): JVM JIT, Python workers, code generation.  The
    # timed pass then measures steady-state query time.  BENCH_WARMUP=0
    # warms up with the flagship only.
    warm = names if os.environ.get("BENCH_WARMUP", "1") != "0" else ["divergent_regions"]
    for name in warm:
        try:
            run(name)
        except Exception:  # noqa: BLE001 - the timed pass reports failures
            pass
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        try:
            times[name] = round(run(name), 3)
            if os.environ.get("BENCH_ROWS"):
                rows[name] = qs[name].build(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001 - report and continue
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
    }
    if rows:
        out["rows"] = rows
    print(json.dumps(out))
    spark.stop()
    if len(times) < len(names):
        sys.exit(1)


if __name__ == "__main__":
    main()
