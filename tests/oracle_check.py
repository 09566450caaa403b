"""Run catalogue queries in Spark and DuckDB and compare them: ``python tests/oracle_check.py [sf_dir] [name...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def clean(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(0.0 if isinstance(v, float) and v == 0 else v)

    return [columns[i] for i in order], sorted(tuple(clean(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    started = time.time()
    df = query(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    spark_time = time.time() - started
    got = rows_of(df.columns, got_rows)
    if sql is None:
        return "rows-only", len(got_rows), spark_time, None
    started = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    sql_time = time.time() - started
    if got == want:
        return "ok", len(got_rows), spark_time, sql_time
    detail = [f"columns {got[0]} / {want[0]}"] if got[0] != want[0] else []
    left, right = set(got[1]), set(want[1])
    detail.append(f"rows {len(got[1])} / {len(want[1])}; only spark {sorted(left - right)[:3]}; only sql {sorted(right - left)[:3]}")
    return "DIFFERENT " + " ".join(detail), len(got_rows), spark_time, sql_time


if __name__ == "__main__":
    import __spark_entry__ as e
    from threatframe.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = e.oracle_sql()
    for name, query in e.queries().items():
        if len(args) > 1 and name not in args[1:]:
            continue
        try:
            status, n, t1, t2 = compare(spark, con, name, query, oracles.get(name), sf_dir)
            print(f"{name:32s} {n:7d} rows  spark {t1:6.2f}s  sql {t2 or 0:6.2f}s  {status[:1500]}", flush=True)
        except Exception as error:
            print(f"{name:32s} FAILED {str(error)[:1200]}", flush=True)
