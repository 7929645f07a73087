"""Runs a query and its SQL counterpart side by side. ``python tests/oracle.py [names or prefixes]``."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def fingerprint(columns: list[str], rows: list) -> tuple:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)
    digest = hashlib.md5("\n".join(lines).encode()).hexdigest()
    return sorted(columns), len(lines), digest, lines


def spark_side(df):
    return fingerprint(df.columns, [tuple(r) for r in df.collect()])


def sql_side(con, sql: str):
    found = con.execute(sql)
    return fingerprint([c[0] for c in found.description], found.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if left[2] == right[2]:
        return None
    a, b = set(left[3]), set(right[3])
    return f"rows {left[1]} vs {right[1]}\n  spark only: {sorted(a - b)[:3]}\n  sql only:   {sorted(b - a)[:3]}"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from reviewlens.session import local_session

    sf = "/root/testdata/sf0.01"
    spark, con, sqls, bad = local_session(), connect(sf), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if len(sys.argv) > 1 and not any(name.startswith(a) for a in sys.argv[1:]):
            continue
        start = time.time()
        try:
            left = spark_side(fn(spark, sf))
            took, begun = time.time() - start, time.time()
            problem = difference(left, sql_side(con, sqls[name])) if name in sqls else None
            mark = "FAIL" if problem else ("ok  " if name in sqls else "rows")
            print(f"{mark} {name:38s} {left[1]:7d} rows  spark {took:5.1f}s  sql {time.time() - begun:5.1f}s", flush=True)
            if problem:
                print("  " + problem[:1500], flush=True)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
            print(f"FAIL {name}\n  {problem}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)
