"""Run oracle SQL in DuckDB over the driver's tables and compare results
order-insensitively (row count, column names, values)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb
import pandas as pd

from bvengine.sources.loader import DRIVER_TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def canon(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    dcols, drows = duck_rows(con, sql)
    res = {
        "spark_rows": len(srows),
        "oracle_rows": len(drows),
        "columns_match": sorted(scols) == sorted(dcols),
    }
    if res["columns_match"]:
        a, b = canon(scols, srows), canon(dcols, drows)
        res["values_match"] = a == b
        if not res["values_match"]:
            sa, sb = set(a), set(b)
            res["only_spark"] = list(sa - sb)[:3]
            res["only_oracle"] = list(sb - sa)[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = sorted(scols), sorted(dcols)
    res["ok"] = res["columns_match"] and res["values_match"] and res["spark_rows"] == res["oracle_rows"]
    return res
