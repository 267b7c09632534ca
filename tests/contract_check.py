"""Runs registered queries against their SQL: ``python tests/contract_check.py [sf] [name ...]``."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query equals its SQL in columns, value types and rows; else what differs."""
    import __spark_entry__ as contract

    df = contract.queries()[name](spark, sf_dir)
    found = normal(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if found else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    wanted = normal(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows / {len(wanted)}"
    if not found:
        return "no rows"
    for a, b in zip(found, wanted):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf, *names = sys.argv[1:] or ["0.01"]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(f"{DATA}/sf{sf}"), 0
    for name in names or contract.queries():
        start = time.time()
        try:
            wrong = differences(spark, con, name, f"{DATA}/sf{sf}")
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            wrong = f"{type(e).__name__}: {str(e)[:600]}"
        failed += wrong is not None
        print(f"{name:28} {time.time() - start:6.1f}s  {wrong or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
