"""Run a Spark DataFrame and a DuckDB SQL string on the same tables and
compare them the way the driver does: same column names, same row count,
same multiset of rows (columns sorted by name, order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only={sorted(set(s_cols) - set(d_cols))} duck-only={sorted(set(d_cols) - set(s_cols))}"
    if len(s_rows) != len(d_rows):
        msg = f"row count spark={len(s_rows)} duck={len(d_rows)}"
    else:
        msg = ""
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        return True, f"{len(s_rows)} rows equal"
    only_s = list((a - b).elements())[:3]
    only_d = list((b - a).elements())[:3]
    names = sorted(s_cols)
    return False, f"{msg} values differ; cols={names}\n spark-only={only_s}\n duck-only={only_d}"
