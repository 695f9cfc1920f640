"""Run a registered Spark query and its DuckDB oracle on the same test
tables and compare row count, column names and the multiset of values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None) if v.tzinfo is None else v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, str(x)) for x in row)


def compare(spark_df, con, sql: str, rel_tol: float = 0.0) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows_raw),
           "columns_match": sorted(s_cols) == sorted(d_cols),
           "spark_columns": sorted(s_cols), "oracle_columns": sorted(d_cols)}
    if not res["columns_match"]:
        res["match"] = False
        return res
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(d_cols)) for r in d_rows_raw]
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    res["exact"] = s_sorted == d_sorted
    if res["exact"] or len(s_sorted) != len(d_sorted):
        res["match"] = res["exact"]
        return res
    diffs = []
    for a, b in zip(s_sorted, d_sorted):
        for x, y in zip(a, b):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=max(rel_tol, 1e-12)):
                continue
            diffs.append((a, b))
            break
    res["match"] = not diffs
    res["diffs"] = diffs[:3]
    return res
