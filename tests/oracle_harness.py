"""Spark-vs-DuckDB comparison: row count, column names/types, value multiset.

Usable from tests and as a script:
``python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return float(f"{v:.9g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def _spark_kind(dtype: str) -> str:
    d = dtype.lower()
    if d in ("int", "integer"):
        return "int32"
    if d in ("bigint", "long"):
        return "int64"
    if d in ("double", "float"):
        return "float"
    if d in ("string",):
        return "string"
    if d.startswith("timestamp"):
        return "timestamp"
    return d


def _duck_kind(dtype: str) -> str:
    d = dtype.upper()
    return {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float", "FLOAT": "float",
            "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
            "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp"}.get(d, d.lower())


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: _spark_kind(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: _duck_kind(str(c[1])) for c in cur.description}
    d_rows = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    res["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} oracle={d_cols}")
    else:
        bad = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        s_sorted = sorted((tuple(r[i] for i in si) for r in s_rows), key=_key)
        d_sorted = sorted((tuple(r[i] for i in di) for r in d_rows), key=_key)
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} oracle={len(d_rows)}")
        elif s_sorted != d_sorted:
            diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
            problems.append(f"values differ, e.g. {diff}")
    res["status"] = "match" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_mod
    from revlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    ok = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "problems": [repr(e)[:800]]}
        ok += r["status"] in ("match", "rows-only")
        print(r, flush=True)
    print(f"{ok}/{len(names or qs)} ok")


if __name__ == "__main__":
    main(sys.argv)
