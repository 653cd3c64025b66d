"""Compare a Spark result with a DuckDB result: rows, column names and types, values.

Used by the tests and by ``check_oracle.py``; values are compared order-insensitively
after rendering every cell canonically (decimals normalized, doubles by ``repr``).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

import duckdb
from pyspark.sql import DataFrame

from .sources.testdata import TABLES


def duck_connection(sf_dir: str) -> "duckdb.DuckDBPyConnection":
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NaN"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


_KIND = {
    "IntegerType": "int32", "INTEGER": "int32",
    "LongType": "int64", "BIGINT": "int64",
    "DoubleType": "float64", "DOUBLE": "float64",
    "StringType": "string", "VARCHAR": "string",
    "DateType": "date", "DATE": "date",
    "BooleanType": "bool", "BOOLEAN": "bool",
    "TimestampNTZType": "timestamp", "TIMESTAMP": "timestamp",
}


def _spark_kind(dt) -> str:
    name = type(dt).__name__
    if name == "DecimalType":
        return f"decimal({dt.precision},{dt.scale})"
    return _KIND.get(name, name)


def _duck_kind(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _KIND.get(t, t)


def summarize_rows(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rendered = sorted("|".join(_cell(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(rendered).encode()).hexdigest()
    return len(rows), h


def compare(spark_df: DataFrame, con, sql: str) -> dict:
    """Return a dict with ``rows_match``, ``schema_match``, ``values_match`` and detail."""
    s_cols = spark_df.columns
    s_types = {f.name: _spark_kind(f.dataType) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: _duck_kind(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    s_n, s_h = summarize_rows(s_cols, s_rows)
    d_n, d_h = summarize_rows(d_cols, d_rows)
    out = {
        "rows": (s_n, d_n), "rows_match": s_n == d_n,
        "schema_match": s_types == d_types,
        "values_match": s_h == d_h and sorted(s_cols) == sorted(d_cols),
    }
    if not out["schema_match"]:
        out["schema"] = {"spark": s_types, "duckdb": d_types}
    if not out["values_match"] and s_n == d_n:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        rs = sorted("|".join(_cell(r[i]) for i in order_s) for r in s_rows)
        rd = sorted("|".join(_cell(r[i]) for i in order_d) for r in d_rows)
        diffs = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        out["first_diffs"] = diffs
    return out
