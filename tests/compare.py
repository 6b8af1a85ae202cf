"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def check(spark, con, folder, name, fn, sql):
    """None when equal, else what differs."""
    df = fn(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return "no SQL to compare with"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} want {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}; got {got[:2]} want {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"got {g}\nwant {w}"
    return None


def main(argv):
    from facetmill.catalog import QUERIES, SQL
    from facetmill.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    only = argv[1:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = check(spark, con, folder, name, fn, SQL.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
