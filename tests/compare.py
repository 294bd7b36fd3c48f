"""Side-by-side check of a registered Spark query against its DuckDB oracle."""
from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ in ("date", "Timestamp", "datetime") else v.isoformat()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def spark_rows(sdf) -> tuple[list[str], list[tuple]]:
    recs = [r.asDict() for r in sdf.collect()]
    cols = sorted(sdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in recs]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None, rel_tol: float = 0.0):
    """Return (ok, message).  Floats must have identical bits (sign of zero
    included), or be within ``rel_tol`` when one is given."""
    con = con or duck(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols, s_rows = spark_rows(sdf)
    ddf = con.execute(sql).df()
    d_cols = sorted(ddf.columns)
    d_rows = rows_of(ddf)
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: row count spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        for c, x, y in zip(s_cols, a, b):
            if x is None and y is None:
                continue
            if isinstance(x, float) or isinstance(y, float):
                if x is None or y is None:
                    return False, f"{name}: value differs in {c}: spark={x!r} duck={y!r}\n{a}\n{b}"
                same = (repr(float(x)) == repr(float(y)) if rel_tol == 0.0  # same bits, incl. -0.0
                        else math.isclose(float(x), float(y), rel_tol=rel_tol, abs_tol=0.0))
                if not same:
                    return False, f"{name}: value differs in {c}: spark={x!r} duck={y!r}\n{a}\n{b}"
            elif x != y and str(x) != str(y):
                return False, f"{name}: value differs in {c}: spark={x!r} duck={y!r}\n{a}\n{b}"
    return True, f"{name}: ok ({len(s_rows)} rows)"
