"""Run a registered Spark query and its DuckDB oracle on the same parquet
tables and compare them order-insensitively (row count, column names, values)."""

from __future__ import annotations

import math
import os

import duckdb

from tidyload.sources.tables import TEST_TABLES


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if not isinstance(v, (list, tuple, dict)) and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return float(f"{v:.9g}")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if len(s) >= 10 and s[10:] in ("", "T00:00:00", " 00:00:00") else s
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_pdf = spark_df.toPandas()
    d_pdf = con.execute(sql).df()
    s_cols, s_rows = rows_of(s_pdf)
    d_cols, d_rows = rows_of(d_pdf)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(s_rows)} rows match"
