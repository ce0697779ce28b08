"""Local Spark-vs-DuckDB comparison, as the correctness gate does it:
row count, column names, and order-insensitive values."""

from __future__ import annotations

import math

import duckdb

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _key(row):
    return tuple((v is None, isinstance(v, str), v if v is not None else 0) for v in row)


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=_key)


def compare(spark_df, con, sql: str) -> dict:
    sp = spark_df.toPandas()
    dk = con.execute(sql).fetchdf()
    out = {"spark_rows": len(sp), "oracle_rows": len(dk)}
    sc, dc = sorted(sp.columns), sorted(dk.columns)
    out["columns_match"] = sc == dc
    if sc != dc:
        out["spark_only"] = sorted(set(sc) - set(dc))
        out["oracle_only"] = sorted(set(dc) - set(sc))
        out["match"] = False
        return out
    dt_sp = {c: str(sp[c].dtype) for c in sc}
    dt_dk = {c: str(dk[c].dtype) for c in sc}
    out["dtype_diffs"] = {c: (dt_sp[c], dt_dk[c]) for c in sc if dt_sp[c] != dt_dk[c]}
    a = rows_of(sp.astype(object).where(sp.notna(), None).to_dict("records"), sc)
    b = rows_of(dk.astype(object).where(dk.notna(), None).to_dict("records"), sc)
    out["match"] = a == b
    if not out["match"]:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["first_diffs"] = [{c: (xv, yv) for c, xv, yv in zip(sc, x, y) if xv != yv} for x, y in bad]
    return out
