from __future__ import annotations

import math


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def rowset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()
