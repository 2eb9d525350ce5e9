"""Order-insensitive comparison of query results (Spark rows vs DuckDB rows).

Columns are matched by sorted name, values are normalised (numbers to
rounded floats, dates to ISO text) and the sorted row lines are hashed.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

from chainfold.plans.testdata import TABLES


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(cols, rows) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    """Run ``df`` and ``sql``; return (equal, short report)."""
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(sql)
    ocols, orows = res.columns, res.fetchall()
    sh, slines = digest(df.columns, rows)
    oh, olines = digest(ocols, orows)
    ok = len(rows) == len(orows) and sorted(df.columns) == sorted(ocols) and sh == oh
    report = f"spark={len(rows)} oracle={len(orows)}"
    if sorted(df.columns) != sorted(ocols):
        report += f" cols {sorted(df.columns)} vs {sorted(ocols)}"
    if not ok:
        a, b = set(slines), set(olines)
        report += f" spark_only={sorted(a - b)[:3]} oracle_only={sorted(b - a)[:3]}"
    return ok, report
