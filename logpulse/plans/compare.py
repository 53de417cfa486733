"""Order-insensitive comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import math

import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    rows = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns spark={sorted(spark_pdf.columns)} duck={sorted(duck_pdf.columns)}"
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    if a == b:
        return None
    diff = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return f"rows spark={len(a)} duck={len(b)} first diff: {diff}"
