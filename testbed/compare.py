"""Run a query in Spark and its oracle in DuckDB and compare all rows, order aside."""

from __future__ import annotations

import datetime as dt
import math
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB inside this process with one view per given table."""
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", value)
    if isinstance(value, dt.datetime):
        return ("ts", value.isoformat())
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count of the Spark result and what differs from the oracle; empty when equal."""
    rows = [tuple(r) for r in df.collect()]
    relation = con.sql(sql)
    expected = relation.fetchall()
    problems = []
    if sorted(df.columns) != sorted(relation.columns):
        return len(rows), [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    got, want = _bag(df.columns, rows), _bag(relation.columns, expected)
    if got != want:
        extra, lacking = got - want, want - got
        problems.append(f"{len(rows)} rows against {len(expected)}")
        problems += [f"only Spark:  {r}" for r in list(extra)[:3]]
        problems += [f"only DuckDB: {r}" for r in list(lacking)[:3]]
    return len(rows), problems


def main() -> None:
    import sys

    from pyspark.sql import SparkSession

    from testbed.oracles import ORACLES
    from testbed.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            n, problems = differences(df, con, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {n:8d} rows {time.perf_counter() - start:6.2f} s")
        for line in problems:
            print("      ", line)
    print(f"{len(names) - failed} of {len(names)} equal at {sf_dir}")
    spark.stop()


if __name__ == "__main__":
    main()
