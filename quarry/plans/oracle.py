"""Local copy of the correctness gate: a Spark query against its DuckDB SQL.

Columns are compared by name, doubles rounded to 6 places, rows order-insensitively."""

from __future__ import annotations

import hashlib
import math

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def _cell(v) -> str:
    import numpy as np
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, np.ndarray):
        v = v.tolist()
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        r = round(v, 6)
        if r == int(r) and abs(r) < 2 ** 53:
            return str(int(r))  # a nullable integer column arrives as float from pandas
        return repr(r)
    if isinstance(v, (list, tuple)):
        return repr([_cell(x) for x in v])
    if isinstance(v, (int,)) or type(v).__name__.startswith("int"):
        return str(int(v))
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    return str(v)


def canonical(pdf: pd.DataFrame) -> tuple[list[str], list[tuple[str, ...]]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_cell(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    rows.sort()
    return cols, rows


def digest(rows: list[tuple[str, ...]]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("\x1f".join(r).encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(spark, name: str, sf_dir: str) -> dict:
    from quarry.plans.registry import all_queries
    q = all_queries()[name]
    got = q.build(spark, sf_dir).toPandas()
    res = {"name": name, "spark_rows": len(got)}
    if q.sql is None:
        res["status"] = "rows-only"
        return res
    exp = duckdb_frame(q.sql, sf_dir)
    gc, gr = canonical(got)
    ec, er = canonical(exp)
    res.update(oracle_rows=len(exp), cols_ok=gc == ec, hash_ok=digest(gr) == digest(er))
    res["status"] = "ok" if res["cols_ok"] and res["hash_ok"] and len(gr) == len(er) else "MISMATCH"
    if res["status"] != "ok":
        res["spark_cols"], res["oracle_cols"] = gc, ec
        sg, se = set(gr), set(er)
        res["only_spark"] = sorted(sg - se)[:5]
        res["only_oracle"] = sorted(se - sg)[:5]
    return res
