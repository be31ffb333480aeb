"""Run registered queries on Spark and their oracles on DuckDB and compare.

usage: python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopledger.plans import registry  # noqa: E402
from shopledger.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v + 0.0:.6g}" if abs(v) > 1e12 else f"{round(v, 6) + 0.0:.6f}"
    if isinstance(v, Decimal):
        return f"decimal {v}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    start = time.time()
    df = fn(spark, sf_dir)
    types = dict(df.dtypes)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if sql is None:
        return f"rows-only  {name}: {len(got)} rows {took:.1f}s {types}"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    kinds = {r[0]: KINDS.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    else:
        bad = {c: (types[c], kinds[c]) for c in types if types[c] != kinds[c]}
        if bad:
            problems.append(f"types {bad}")
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        problems.append(f"rows {len(got)} vs {len(want)}; spark-only {list(a)[:3]}; oracle-only {list(b)[:3]}")
    if not got:
        problems.append("no rows")
    return f"{'ok        ' if not problems else 'MISMATCH  '} {name}: {len(got)} rows {took:.1f}s " + "; ".join(problems)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    queries, oracles = registry.queries(), registry.oracle_sql()
    for name in args or queries:
        try:
            print(compare(spark, con, name, queries[name], oracles.get(name), sf_dir), flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"ERROR      {name}: {type(e).__name__} {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main()
