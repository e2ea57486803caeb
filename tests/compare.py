"""Compare a Spark result with a DuckDB oracle result.

Row count, column names, and an order-insensitive hash of the values with
columns sorted by name (floats rounded to 6 places before hashing).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(rows), [columns[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest()


def spark_fingerprint(df):
    rows = [tuple(r) for r in df.collect()]
    return fingerprint(df.columns, rows)


def duck_fingerprint(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return fingerprint(cols, cur.fetchall())


def diff(df, con, sql, limit=5):
    """Rows present on one side only (for debugging a mismatch)."""
    srows = {repr(tuple(_norm(v) for v in r)) for r in
             [tuple(x[c] for c in sorted(df.columns)) for x in df.collect()]}
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    drows = {repr(tuple(_norm(r[i]) for i in idx)) for r in cur.fetchall()}
    return sorted(srows - drows)[:limit], sorted(drows - srows)[:limit]
