"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    df = df.reindex(sorted(df.columns), axis=1)
    return sorted(tuple(_cell(v) for v in r) for r in df.itertuples(index=False))


def assert_same(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
