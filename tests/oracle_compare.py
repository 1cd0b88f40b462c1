"""Run a registered Spark query and its DuckDB oracle side by side.

Comparison: same column names, same row count, and the same multiset of rows
after sorting (floats compared exactly and, separately, to 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int, float)):
        return (1, float(v) if isinstance(v, float) else v)
    return (2, str(v))


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT"}


def _rows(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    scols = sorted(sdf.columns)
    out = {"name": name, "spark_s": round(t1 - t0, 2), "spark_rows": len(srows)}
    sql = entry.oracle_sql().get(name)
    if sql is None:
        out["status"] = "no-oracle"
        return out
    rel = con.sql(sql)
    dcols = sorted(rel.columns)
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    out["duck_s"] = round(time.time() - t1, 2)
    out["duck_rows"] = len(drows)
    if scols != dcols:
        out["status"] = f"columns differ: spark={scols} duck={dcols}"
        return out
    stypes = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if stypes != dtypes:
        out["status"] = f"types differ: spark={stypes} duck={dtypes}"
        return out
    if len(srows) != len(drows):
        out["status"] = "row count differs"
        return out
    a, b = _rows(srows, scols), _rows(drows, dcols)
    if a == b:
        out["status"] = "ok"
        return out
    bad = 0
    first = None
    for x, y in zip(a, b):
        same = all(
            (u == v) or (u[0] == 1 == v[0] and isinstance(u[1], float) and isinstance(v[1], (int, float))
                         and math.isclose(u[1], v[1], rel_tol=1e-9, abs_tol=1e-12))
            for u, v in zip(x, y))
        if not same:
            bad += 1
            first = first or (x, y)
    out["status"] = "ok~" if bad == 0 else f"{bad} rows differ, first: {first}"
    return out
