"""Run the registered queries next to their SQL and compare whole results.

    python -m verification.compare [directory] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from ledgerline.queries import QUERIES, run
from verification.oracle import expected_sql

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def oracle_connection(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as from '{directory}/{table}.parquet'")
    return connection


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    relation = connection.sql(sql)
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {sorted(result.columns)} != {sorted(relation.columns)}"
    ours = _sorted_rows(result.columns, result.collect())
    theirs = _sorted_rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if repr(mine) != repr(other):
            return f"{mine} != {other}"
    return None


def main(directory: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(directory)
    expected = expected_sql()
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        problem = difference(run(name, spark, directory), connection, expected[name])
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
