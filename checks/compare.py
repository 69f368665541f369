"""Run registered queries against their expected results in DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: str = "8") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortlens")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows in a total order, with dates as dates and every NULL alike."""
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[column]):
            frame[column] = frame[column].dt.date
    frame = frame.astype(object).where(frame.notna(), None)
    order = frame.map(repr).sort_values(list(frame.columns), kind="stable").index
    return frame.loc[order].reset_index(drop=True)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str:
    """Empty when the two hold the same rows, to the last bit."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} instead of {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    left, right = normalised(actual), normalised(expected)
    unequal = (left != right) & ~(left.isna() & right.isna())
    rows = unequal.any(axis=1)
    if not rows.any():
        return ""
    first = rows.idxmax()
    return f"{rows.sum()} rows differ, first {left.loc[first].to_dict()} instead of {right.loc[first].to_dict()}"


def main() -> int:
    from checks.registry import REGISTRY

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark, connection = local_session(), duckdb_over(sf_dir)
    failed = []
    for name in names:
        started = time.time()
        actual = REGISTRY[name].run(spark, sf_dir).toPandas()
        spent = time.time() - started
        problem = differences(actual, connection.execute(REGISTRY[name].expected).df())
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={len(actual)} spark={spent:.1f}s {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
