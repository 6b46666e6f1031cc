"""Spark-vs-DuckDB comparison in the driver's style: row count, column names,
order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import math
import datetime as dt
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest(), keys


def compare(spark, con, build, sql, sf_dir):
    sdf = build(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    sh, sk = _digest(scols, srows)
    dh, dk = _digest(dcols, drows)
    out = {
        "rows_spark": len(srows), "rows_oracle": len(drows),
        "cols_match": sorted(scols) == sorted(dcols), "hash_match": sh == dh,
        "spark_cols": sorted(scols), "oracle_cols": sorted(dcols),
    }
    if sh != dh:
        a, b = set(sk), set(dk)
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out
