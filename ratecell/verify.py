"""Side-by-side check of a Spark result against DuckDB SQL on the same parquet files.

Test tooling only: small results are brought to the driver to be compared.
"""

from __future__ import annotations

import math
from collections import Counter

from ratecell.sources.tables import TABLES


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    return rel.columns, [str(t) for t in rel.types], rel.fetchall()


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if digits is None else round(v, digits)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i], digits) for i in order) for r in rows]


def compare(spark_df, con, sql: str, digits: int | None = None) -> dict:
    """Row count, column names and an order-insensitive multiset match."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_types, d_rows = duck_rows(con, sql)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
        out["match"] = False
        return out
    a = Counter(_canon(s_cols, s_rows, digits))
    b = Counter(_canon(d_cols, d_rows, digits))
    out["match"] = a == b
    if not out["match"]:
        out["spark_extra"] = list((a - b).elements())[:3]
        out["oracle_extra"] = list((b - a).elements())[:3]
        out["columns"] = sorted(s_cols)
    return out
