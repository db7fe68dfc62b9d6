"""Run the registered queries that have SQL side by side with it: ``python tests/compare.py DIRECTORY [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_points
from tallyframe.checks.queries import REPORT_ORDER
from tools import first_fall

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "conversations")


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return connection


def normal(rows, columns: list[str]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(row[i]) for i in order) for row in rows)


def spark_rows(spark: SparkSession, name: str, directory: str):
    frame = entry_points.queries()[name](spark, directory)
    rows = frame.collect()
    fall = first_fall([tuple(row[key] for key in REPORT_ORDER.get(name, ())) for row in rows])
    if fall is not None:
        raise ValueError(f"row {fall} is out of order")
    return normal(rows, frame.columns)


def duckdb_rows(connection: duckdb.DuckDBPyConnection, name: str):
    result = connection.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    return normal(result.fetchall(), columns)


def main(directory: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    bad = 0
    for name in names or entry_points.oracle_sql():
        try:
            start = time.time()
            left = spark_rows(spark, name, directory)
            middle = time.time()
            right = duckdb_rows(connection, name)
            end = time.time()
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAILED {name}: {str(error)[:600]}", flush=True)
            continue
        same = left == right
        bad += not same
        print(f"{'ok    ' if same else 'DIFFER'} {name} rows={len(left[1])} spark={middle - start:.1f}s duckdb={end - middle:.1f}s", flush=True)
        if not same:
            print("  columns", left[0] == right[0], "rows", len(left[1]), len(right[1]))
            for side, mine, other in (("spark", left, right), ("duckdb", right, left)):
                others = set(other[1])
                print(f"  only {side}:", [r for r in mine[1] if r not in others][:3])
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
