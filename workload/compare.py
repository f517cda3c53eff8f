"""Run a query in Spark and its text in DuckDB and compare the rows, order ignored."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

from workload.standins import BASE


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in BASE:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, (Decimal, float)):
        value = float(value)
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def spark_rows(frame: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    return names, Counter(tuple(_cell(row[n]) for n in names) for row in frame.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())


def difference(frame: DataFrame, con, sql: str) -> str | None:
    """None if both agree, else a short account of how they differ."""
    names, ours = spark_rows(frame)
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; "
            f"only spark {sum(only_ours.values())}: {list(only_ours)[:2]}; "
            f"only duckdb {sum(only_theirs.values())}: {list(only_theirs)[:2]}; columns {names}"
        )
    return None
