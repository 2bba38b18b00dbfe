"""Compare a Spark query with its DuckDB text on the driver tables, as the driver does."""

from __future__ import annotations

import hashlib
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v == int(v) and abs(v) < 1e15 else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v if isinstance(v, (int, str)) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def digest(rows):
    return hashlib.sha256(repr(rows).encode()).hexdigest()


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}; spark {sr[:2]} duck {dr[:2]}"
    if digest(sr) != digest(dr):
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        only_s = sorted(set(sr) - set(dr), key=repr)[:3]
        only_d = sorted(set(dr) - set(sr), key=repr)[:3]
        return f"{len(bad)} rows differ; cols {sc}; spark {only_s} duck {only_d}"
    return None
