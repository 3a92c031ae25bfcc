"""Local stand-in for the driver's correctness gate.

Runs each registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables, then compares row count, column names and an
order-insensitive hash of the values (floats rounded to 6 decimals).

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from genoframe.plans.catalog import all_queries  # noqa: E402
from genoframe.session import local_session  # noqa: E402
from genoframe.sources.fixtures import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.build(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"rows {name}: spark {len(srows)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            res = con.execute(q.oracle)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sn, sh = digest(scols, srows)
        on, oh = digest(ocols, orows)
        ok = sorted(scols) == sorted(ocols) and sn == on and sh == oh
        status = "ok  " if ok else "FAIL"
        if not ok:
            bad += 1
        print(f"{status} {name}: spark {sn} rows, oracle {on} rows, cols_equal={sorted(scols) == sorted(ocols)} hash_equal={sh == oh} ({ts:.1f}s)")
        if not ok and sorted(scols) != sorted(ocols):
            print("   spark cols", scols, "\n   oracle cols", ocols)
        if not ok and sorted(scols) == sorted(ocols) and os.environ.get("DIFF"):
            order_s = [scols.index(c) for c in sorted(scols)]
            order_o = [ocols.index(c) for c in sorted(ocols)]
            ss = {"|".join(_norm(r[i]) for i in order_s) for r in srows}
            oo = {"|".join(_norm(r[i]) for i in order_o) for r in orows}
            print("   cols", sorted(scols))
            print("   only spark", sorted(ss - oo)[:5])
            print("   only oracle", sorted(oo - ss)[:5])
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
