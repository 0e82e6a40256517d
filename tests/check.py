"""Run registered queries and their SQL restatements side by side: ``python tests/check.py [folder] [names…]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        return float(value)
    return str(value)


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, query, sql):
    """(spark rows, oracle rows, first differences) of one query."""
    df = query(spark, folder)
    got = as_bag(df.columns, df.collect())
    rel = con.sql(sql)
    want = as_bag(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return sum(got.values()), sum(want.values()), [("columns", sorted(df.columns), sorted(rel.columns))]
    diff = [("spark", k) for k in list((got - want).keys())[:3]]
    diff += [("sql", k) for k in list((want - got).keys())[:3]]
    return sum(got.values()), sum(want.values()), diff


def main() -> None:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            if name not in sqls:
                print(f"{name:24} rows={query(spark, folder).count()} (no SQL)")
                continue
            got, want, diff = compare(spark, con, folder, query, sqls[name])
        except Exception as exc:  # noqa: BLE001 - a report over all queries
            bad += 1
            print(f"{name:24} ERROR {str(exc)[:700]}")
            continue
        ok = not diff and got > 0
        bad += not ok
        print(f"{name:24} {'ok ' if ok else 'BAD'} rows={got}/{want} {time.time() - start:.1f}s", flush=True)
        for d in diff:
            print("     ", d)
    print("bad:", bad)


if __name__ == "__main__":
    main()
