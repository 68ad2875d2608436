"""Result comparison used by the tests and ``scripts/check_oracle.py``: row count, column names and
an order-insensitive hash of normalised values (floats rounded, decimals by value)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

ORACLE_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ORACLE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def fingerprint(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), cols, h


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def diff(spark_res, duck_res, limit: int = 5) -> str:
    (sc, sr), (dc, dr) = spark_res, duck_res
    out = []
    if sorted(sc) != sorted(dc):
        out.append(f"columns only in spark: {sorted(set(sc) - set(dc))}; only in oracle: {sorted(set(dc) - set(sc))}")
        return "\n".join(out)
    order = sorted(sc)
    si = [sc.index(c) for c in order]
    di = [dc.index(c) for c in order]
    a = sorted(repr(tuple(_norm(r[i]) for i in si)) for r in sr)
    b = sorted(repr(tuple(_norm(r[i]) for i in di)) for r in dr)
    sa, sb = set(a), set(b)
    out.append(f"rows spark={len(a)} oracle={len(b)}; columns={order}")
    for x in [x for x in a if x not in sb][:limit]:
        out.append(f"  spark only: {x}")
    for x in [x for x in b if x not in sa][:limit]:
        out.append(f"  oracle only: {x}")
    # per-column mismatch summary when row counts agree
    if len(a) == len(b):
        bad = []
        for j, c in enumerate(order):
            if sorted(repr(t[j]) for t in map(eval, a)) != sorted(repr(t[j]) for t in map(eval, b)):
                bad.append(c)
        out.append(f"  differing columns: {bad}")
    return "\n".join(out)


def _strict(v):
    """Type-and-text form of a value, as a hash over ``str(value)`` would see it."""
    if isinstance(v, float):
        return ("float", repr(round(v, 9)))
    return (type(v).__name__, str(v))


def strict_diff(spark_res, duck_res) -> list[str]:
    """Columns whose Python value types or exact text differ between the two results
    (rows matched by sorting on the lenient normal form)."""
    (sc, sr), (dc, dr) = spark_res, duck_res
    if sorted(sc) != sorted(dc) or len(sr) != len(dr):
        return ["<shape>"]
    order = sorted(sc)
    si = [sc.index(c) for c in order]
    di = [dc.index(c) for c in order]
    key = lambda idx: (lambda r: repr(tuple(_norm(r[i]) for i in idx)))
    ar = sorted(sr, key=key(si))
    br = sorted(dr, key=key(di))
    bad = []
    for j, c in enumerate(order):
        if any(_strict(x[si[j]]) != _strict(y[di[j]]) for x, y in zip(ar, br)):
            ex = next((x[si[j]], y[di[j]]) for x, y in zip(ar, br) if _strict(x[si[j]]) != _strict(y[di[j]]))
            bad.append(f"{c}: spark={ex[0]!r} oracle={ex[1]!r}")
    return bad
