"""Run a query in Spark and its SQL counterpart in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normalized(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.astype(object).itertuples(index=False):
        rows.append(tuple("<null>" if pd.isna(v) else str(v) for v in row))
    return sorted(rows)


def kinds(pdf: pd.DataFrame) -> dict[str, str]:
    return {c: pdf[c].dtype.kind for c in sorted(pdf.columns)}


def difference(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} and {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return f"{len(spark_pdf)} and {len(oracle_pdf)} rows"
    for c in spark_pdf.columns:
        if "datetime" in str(oracle_pdf[c].dtype) or "datetime" in str(spark_pdf[c].dtype):
            spark_pdf[c], oracle_pdf[c] = pd.to_datetime(spark_pdf[c]), pd.to_datetime(oracle_pdf[c])
    a, b = kinds(spark_pdf), kinds(oracle_pdf)
    if a != b:
        return f"types {[(c, a[c], b[c]) for c in a if a[c] != b[c]]}"
    left, right = _normalized(spark_pdf), _normalized(oracle_pdf)
    bad = [(x, y) for x, y in zip(left, right, strict=True) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
