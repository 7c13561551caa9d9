"""Spark-versus-DuckDB comparison used by the tests (mirrors the driver's check).

Row count, column names and an order-insensitive hash of the values; floats are compared after
rounding so that summation order does not matter.
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        # a long column with nulls reaches pandas as float on one side and as Int64 on the other
        return int(v) if v.is_integer() else round(v, digits) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows_of(pdf: pd.DataFrame, digits: int) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(repr(_norm(x, digits)) for x in rec))
    return sorted(out)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 6) -> list[str]:
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        problems.append(f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}")
        return problems
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count {len(spark_pdf)} vs {len(duck_pdf)}")
    a, b = rows_of(spark_pdf, digits), rows_of(duck_pdf, digits)
    if a != b:
        sa, sb = set(a), set(b)
        only_a = sorted(sa - sb)[:3]
        only_b = sorted(sb - sa)[:3]
        problems.append(f"values differ; spark-only {only_a} duck-only {only_b}")
    return problems
