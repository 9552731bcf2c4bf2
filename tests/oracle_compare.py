"""Run registered queries beside their SQL and compare rows, columns and values.

``python tests/oracle_compare.py [folder] [name or prefix ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v.is_integer() else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def compare(spark, con, folder, query):
    df = query.run(spark, folder)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return None, len(mine[1])
    cur = con.execute(query.sql)
    theirs = normal([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", 0
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows, expected {len(theirs[1])}", len(mine[1])
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine[1])} rows differ, first {mine[0]}: {bad[0][0]} expected {bad[0][1]}", len(mine[1])
    return "", len(mine[1])


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from plumbline.plans.star import all_queries
    from plumbline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, query in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            problem, n = compare(spark, con, folder, query)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", 0
        state = "ok" if problem == "" else "rows only" if problem is None else f"FAIL {problem}"
        failed += bool(problem)
        print(f"{name:32s} {n:7d} rows {time.time() - t:6.2f}s {state}", flush=True)
    print("failed:", failed)
