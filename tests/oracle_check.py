"""Compare a query's Spark result with its DuckDB result, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (pd.Timestamp,)) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(canonical(v) for v in row) for row in frame.itertuples(index=False, name=None))


def compare(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str:
    """Empty when equal, else a short report."""
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(duck_frame.columns)}"
    a, b = rows(spark_frame), rows(duck_frame)
    if a == b:
        return ""
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"rows {sum(a.values())} vs {sum(b.values())}; {sum((a-b).values())} differ; spark only {str(only_a)[:900]}; duckdb only {str(only_b)[:900]}"
