"""Compare a registered Spark query with its DuckDB twin the way the driver
does: row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def frame_hash(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def spark_rows(df) -> pd.DataFrame:
    rows = df.collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=df.columns)


def compare(spark_df, con, sql: str) -> dict:
    s = spark_rows(spark_df)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    o = pd.DataFrame(rel.fetchall(), columns=names)
    res = {"rows_spark": len(s), "rows_oracle": len(o),
           "cols_match": sorted(s.columns) == sorted(o.columns)}
    res["hash_match"] = res["cols_match"] and frame_hash(s) == frame_hash(o)
    if not res["cols_match"]:
        res["cols"] = (sorted(s.columns), sorted(o.columns))
    return res
