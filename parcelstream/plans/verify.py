"""Spark-vs-DuckDB comparison used by the tests and ``tools/oracle_check.py``:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import decimal
import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{norm(k)}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(df, con, sql: str) -> tuple[bool, str]:
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    hs, ls = digest(scols, srows)
    ho, lo = digest(ocols, orows)
    ok = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
    if ok:
        return True, f"{len(srows)} rows"
    a, b = set(ls), set(lo)
    detail = [f"spark {len(srows)} rows {sorted(scols)}", f"oracle {len(orows)} rows {sorted(ocols)}"]
    detail += ["spark-only : " + x[:300] for x in list(a - b)[:3]]
    detail += ["oracle-only: " + x[:300] for x in list(b - a)[:3]]
    return False, "\n".join(detail)
