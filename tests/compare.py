"""Run registered queries on Spark and their SQL on DuckDB and compare rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else round(value, 9)
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours = spark_df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    a, b = _rows(ours, spark_df.columns), _rows(theirs, names)
    if len(a) != len(b):
        only = list(set(a) ^ set(b))[:4]
        return f"rows {len(a)} != {len(b)}; e.g. {only}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(names)}); e.g. ours {bad[0][0]} theirs {bad[0][1]}"
    return None if a else "both empty"


def main() -> None:
    import __spark_entry__ as entry
    from tickerlake.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("compare", cpus=8, partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in [n for n in queries if not args or any(a in n for a in args)]:
        start = time.time()
        try:
            if name in oracle:
                verdict = difference(queries[name](spark, sf), con, oracle[name])
            else:
                verdict = None if queries[name](spark, sf).count() else "empty"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:900]}"
        failed += verdict is not None
        tag = "ok" if verdict is None else "FAIL"
        print(f"{tag:5}{name:34}{time.time() - start:6.2f}s {'' if name in oracle else '(rows only)'} {verdict or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
