"""Run every registered query and its SQL twin over one folder and compare them whole.

Usage: python tests/oracle.py [folder of tables] [part of a query name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def normal(names: list[str], rows: list[tuple]) -> list[str]:
    """Rows with columns in name order, as sorted exact text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_value(r[i]) for i in order]) for r in rows)


def spark_rows(df: DataFrame) -> list[str]:
    return normal(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), normal(names, cursor.fetchall())


def main(sf_dir: str, wanted: list[str], shared: str) -> int:
    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {len(got)} {took:.2f}s", flush=True)
                continue
            names, expected = oracle_rows(con, oracles[name])
            if sorted(df.columns) != names:
                raise AssertionError(f"columns {sorted(df.columns)} != {names}")
            if got != expected:
                extra = sorted(set(got) - set(expected))[:3]
                lacking = sorted(set(expected) - set(got))[:3]
                raise AssertionError(
                    f"{len(got)} rows, expected {len(expected)}: {extra} for {lacking}"
                )
            print(f"ok    {name} {len(got)} {took:.2f}s", flush=True)
        except Exception as e:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:900]}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    with tempfile.TemporaryDirectory(prefix="oracle-", ignore_cleanup_errors=True) as shared:
        failed = main(folder, sys.argv[2:], shared)
    sys.exit(1 if failed else 0)
