"""Query name -> (Spark callable, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanops.session import tune
from loanops.sources.catalog import Tables
from workload.standins import oracle, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def keep(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = lambda spark, folder: fn(tables(tune(spark), folder))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return keep
