"""Compare registered queries with their SQL on the bundled tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from lexroll.plans.registered import QUERIES, SQL

    folder = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            columns, rows = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - start
            start = time.time()
            if name not in SQL:
                print(f"{name}: rows only, {len(rows)} rows, spark {took:.1f}s", flush=True)
                continue
            other, expected = sql_rows(con, SQL[name])
            same = "ok" if columns == other and rows == expected else "DIFFERENT"
            print(f"{name}: {same} {len(rows)} / {len(expected)} rows, spark {took:.1f}s, sql {time.time() - start:.1f}s", flush=True)
            if same != "ok":
                print("   ", columns, other)
                a, b = set(rows), set(expected)
                print("    spark only", str(sorted(a - b, key=repr)[:3])[:900])
                print("    sql only  ", str(sorted(b - a, key=repr)[:3])[:900])
        except Exception as error:
            print(f"{name}: FAILED {type(error).__name__} {str(error)[:1500]}", flush=True)
