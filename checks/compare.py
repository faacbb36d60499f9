"""Run queries on Spark and DuckDB and compare rows regardless of order: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.binding import BASE_TABLES
from checks.registry import CHECKS
from martloom.session import recommended


def _plain(value):
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str:
    """Empty text when both sides agree."""
    check = CHECKS[name]
    frame = check.run(spark, sf_dir)
    actual = _rows(frame.columns, frame.collect())
    if check.sql is None:
        return ""
    result = connection.execute(check.sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    expected = _rows(columns, result.fetchall())
    if actual == expected:
        return "" if actual else "no rows on either side"
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; {sorted(columns)}\n   only Spark:"
        f" {list(extra)[:3]}\n   only SQL: {list(lacking)[:3]}"
    )


def local_session(cores: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("martloom-checks")
    spark = recommended(
        builder, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
                   "spark.ui.showConsoleProgress": "false"}
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(CHECKS)
    spark, connection, bad = local_session(), duck(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            text = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name} {time.time() - started:.2f}s {text}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
