"""Run registered queries beside their SQL in DuckDB and compare columns, types and values.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def kind(t: str) -> str:
    t = t.lower().replace(" not null", "")
    for a, b in {"large_string": "string", "timestamp[us, tz=utc]": "timestamp[us]", "element": "item", "l: ": "item: "}.items():
        t = t.replace(a, b)
    return t


def rows_of(table, names):
    return sorted((tuple(plain(r[n]) for n in names) for r in table.to_pylist()), key=repr)


def check(spark, con, name, folder, count_only=False):
    query, sql = E.queries()[name], E.oracle_sql().get(name)
    start = time.time()
    mine = query(spark, folder).toArrow()
    took = time.time() - start
    if sql is None:
        return f"rows-only {mine.num_rows}", took
    theirs = con.execute(sql).to_arrow_table()
    a, b = sorted(mine.column_names), sorted(theirs.column_names)
    if a != b:
        return f"COLUMNS {a} {b}", took
    types = [(n, kind(str(mine.schema.field(n).type)), kind(str(theirs.schema.field(n).type))) for n in a]
    bad = [t for t in types if t[1] != t[2]]
    x, y = rows_of(mine, a), rows_of(theirs, a)
    if x != y:
        only_x, only_y = [r for r in x if r not in set(y)][:3], [r for r in y if r not in set(x)][:3]
        return f"VALUES {len(x)} {len(y)} {a}\n   spark {only_x}\n   duck  {only_y}", took
    if bad:
        return f"TYPES {bad} ({len(x)} rows)", took
    return f"ok {len(x)}" + (" EMPTY" if not x else ""), took


def main():
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = session(), database(folder)
    failed = 0
    for name in args.names or E.queries():
        try:
            result, took = check(spark, con, name, folder)
        except Exception as exc:  # noqa: BLE001
            result, took = f"ERROR {type(exc).__name__} {str(exc)[:600]}", 0.0
        failed += not result.startswith(("ok", "rows-only"))
        print(f"{name:32s} {took:6.2f}s {result}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
