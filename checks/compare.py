"""Run queries in Spark and DuckDB over the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when columns and rows are equal; else a few lines that say what differs."""
    result = connection.execute(sql)
    wanted_columns = [column[0] for column in result.description]
    if sorted(wanted_columns) != sorted(spark_df.columns):
        return [f"columns differ: {sorted(set(wanted_columns) ^ set(spark_df.columns))}"]
    wanted = bag(wanted_columns, result.fetchall())
    got = bag(spark_df.columns, spark_df.collect())
    lines = []
    if wanted != got:
        missing, extra = wanted - got, got - wanted
        lines.append(f"rows: {sum(got.values())} of {sum(wanted.values())}, {sum(missing.values())} missing")
        lines += [f"  missing {row}" for row in sorted(missing, key=str)[:3]]
        lines += [f"  extra   {row}" for row in sorted(extra, key=str)[:3]]
    return lines
