"""Spark-vs-DuckDB comparison used by the tests and ``scripts/check_oracle.py``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
import pandas as pd

from tradeflow.sources.tables import TABLE_NAMES, table_path

# Exact comparison of doubles (no rounding) when TF_EXACT=1.
EXACT = os.environ.get("TF_EXACT") == "1"


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _canon(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if value is pd.NaT:
        return None
    if isinstance(value, (bool,)):
        return bool(value)
    if isinstance(value, (int, float, decimal.Decimal)) or hasattr(value, "dtype"):
        try:
            f = float(value)
        except (TypeError, ValueError):
            return str(value)
        if math.isnan(f):
            return None
        return f if EXACT else round(f, 6)
    if isinstance(value, pd.Timestamp):
        value = value.to_pydatetime()
    if isinstance(value, dt.datetime):
        if value.time() == dt.time(0):
            return value.date().isoformat()
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def canonical_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(spark_df, con, sql: str) -> dict:
    s_cols, s_rows = spark_rows(spark_df)
    o_cols, o_rows = duck_rows(con, sql)
    result = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
        "spark_columns": s_cols,
        "oracle_columns": o_cols,
    }
    if result["columns_match"]:
        a = canonical_rows(s_cols, s_rows)
        b = canonical_rows(o_cols, o_rows)
        result["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            result["only_spark"] = sorted(sa - sb, key=str)[:5]
            result["only_oracle"] = sorted(sb - sa, key=str)[:5]
    else:
        result["values_match"] = False
    result["ok"] = (result["columns_match"] and result["values_match"]
                    and result["spark_rows"] == result["oracle_rows"])
    return result
