"""Runs registered queries beside their oracles and compares rows, columns and values.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a result and its oracle, None if nothing does."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} but expected {sorted(names)}"
    wanted = _sorted_rows(names, expected.fetchall())
    found = _sorted_rows(df.columns, df.collect())
    if len(found) != len(wanted):
        return f"{len(found)} rows but expected {len(wanted)}"
    for got, want in zip(found, wanted):
        if got != want or [type(x) for x in got] != [type(x) for x in want]:
            return f"{got} but expected {want}"
    return None


def main(arguments: list[str]) -> int:
    from wardflow.session import local_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark: SparkSession = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    faults = 0
    for name in arguments[1:] or QUERIES:
        started = time.monotonic()
        try:
            fault = difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
        except Exception as error:  # noqa: BLE001 - a report over all queries
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        faults += fault is not None
        print(f"{name}: {fault or 'same'} ({time.monotonic() - started:.1f} s)", flush=True)
    print(f"{faults} of {len(arguments[1:] or QUERIES)} differ; no oracle: "
          f"{sorted(set(QUERIES) - set(ORACLES))}; no query: {sorted(set(ORACLES) - set(QUERIES))}")
    return faults


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
