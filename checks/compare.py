"""Runs registered queries against their SQL counterparts.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .oracle import ORACLE
from .queries import QUERIES


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def canonical(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def _text(value: object) -> str:
    if value is None or value is pd.NaT:
        return "␀"
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}" if not isinstance(value, int) else str(int(value))


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    expected = canonical(relation.fetchall(), names)
    actual = canonical([tuple(r) for r in df.collect()], df.columns)
    if expected == actual:
        return None
    only_sql = sorted(set(expected) - set(actual))[:2]
    only_spark = sorted(set(actual) - set(expected))[:2]
    return f"{len(actual)} rows, expected {len(expected)}\n  only sql {only_sql}\n  only spark {only_spark}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_over(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
        except Exception as error:  # report, go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name}: {found or 'same'} ({time.time() - start:.1f}s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
