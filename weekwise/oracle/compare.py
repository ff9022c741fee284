"""Order-insensitive comparison of a Spark result with a DuckDB query.

Used by the tests and by ``tools``; mirrors what the driver's correctness
gate checks: row count, column names, and a hash of the rows where each
value is normalised (floats rounded to 6 decimals, decimals as floats).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
from collections import Counter


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if f != f:
            return "NULL"
        return f"{round(f, 6):.6f}"
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def row_multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def digest(ms: Counter) -> str:
    h = hashlib.sha256()
    for row, n in sorted(ms.items()):
        h.update(repr((row, n)).encode())
    return h.hexdigest()[:16]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    con.sql(f"CREATE OR REPLACE VIEW oracle_rows AS {sql}")   # as the driver does
    rel = con.sql("SELECT * FROM oracle_rows")
    d_cols = [c for c in rel.columns]
    d_rows = rel.fetchall()
    s_ms, d_ms = row_multiset(s_cols, s_rows), row_multiset(d_cols, d_rows)
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": s_ms == d_ms,
    }
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
    if not out["values_match"] and out["columns_match"]:
        out["spark_not_oracle"] = list((s_ms - d_ms).elements())[:5]
        out["oracle_not_spark"] = list((d_ms - s_ms).elements())[:5]
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def duckdb_with_views(sf_dir: str, tables=("events",)):
    import duckdb
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
