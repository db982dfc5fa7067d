"""Compare the registered queries with their oracles: ``python -m workload.check DIR [NAME..]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from workload.oracle import ORACLES
from workload.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return value


def rows_of(frame_columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(frame_columns)), key=lambda i: frame_columns[i])
    values = [tuple(_normal(r[i]) for i in order) for r in rows]
    return [frame_columns[i] for i in order], sorted(values, key=repr)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str,
            name: str) -> str | None:
    """None where both sides agree exactly, else what differs first."""
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want_columns, want = rows_of(columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"{len(differing)} of {len(got)} rows differ: {differing[0][0]} != {differing[0][1]}"
    return None


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name) if name in ORACLES else "no oracle"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
