"""Run registered queries against their DuckDB oracles and compare results exactly.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares column names, row counts, column types (by family) and the multiset of
rows; floats must be equal (NaN equals NaN).
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
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), repr(x)) for x in row)


def _family(t: str) -> str:
    t = t.lower()
    if t.startswith(("int", "bigint", "smallint", "tinyint", "long", "short", "byte")):
        return "int32" if t in ("int", "integer", "int32") else ("int64" if t in ("bigint", "long", "int64") else t)
    if t in ("double", "float64"):
        return "double"
    if t in ("string", "varchar"):
        return "string"
    if t in ("boolean", "bool"):
        return "bool"
    return t


def spark_types(df) -> dict[str, str]:
    m = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "double", "StringType": "string",
         "BooleanType": "bool", "FloatType": "float"}
    return {f.name: m.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}


def duck_types(rel) -> dict[str, str]:
    m = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "bool",
         "FLOAT": "float"}
    return {n: m.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> tuple[bool, str, float]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    dt = time.time() - t0
    s_cols = sdf.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}", dt
    st, dtp = spark_types(sdf), duck_types(rel)
    bad_t = {c: (st[c], dtp[c]) for c in s_cols if st[c] != dtp[c]}
    if bad_t:
        return False, f"types differ: {bad_t}", dt
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}", dt
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    for a, b in zip(s_norm, d_norm):
        if a != b:
            return False, f"first differing row: spark={a} duck={b} cols={order}", dt
    return True, f"{len(s_rows)} rows", dt


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from panelspark.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, oracle = queries(), oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in oracle:
            print(f"SKIP  {name}: no oracle")
            continue
        try:
            ok, msg, dt = compare(spark, name, fn, oracle[name], sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg, dt = False, f"error: {type(e).__name__}: {str(e)[:400]}", 0.0
        fails += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:34s} {dt:6.2f}s  {msg}", flush=True)
    print(f"{fails} failing")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
