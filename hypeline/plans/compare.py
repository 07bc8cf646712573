"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


EXACT_FLOATS = False   # True: compare doubles bit for bit (repr) instead of to 6 decimals


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if EXACT_FLOATS else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(cols, rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {sorted(cols)} vs {sorted(ocols)}"
    if len(rows) != len(orows):
        return False, f"row counts differ: {len(rows)} vs {len(orows)}"
    if digest(cols, rows) != digest(ocols, orows):
        return False, "values differ"
    return True, f"{len(rows)} rows"
