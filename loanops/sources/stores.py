"""Tables laid out once for the reports that read them again and again.

* ``write_keyed``: a history bucketed and sorted by its key. Ranks, aggregates and joins on the key read it without an exchange.
  A bucket is read by one task, so the rows of hot keys, and of null keys, lie apart in a second table that is read like any other.
* ``write_dated``: a table in one folder per day, month or year of a time column. A report's look-back is a partition filter, so the files
  that are read follow the window, not the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanops.functions.timekit import midnight
from loanops.operators.joins import hot_keys
from loanops.sources.catalog import Tables

# Partition column of a dated table: the first day of the period.
PERIOD = "__period"


@dataclass(frozen=True)
class KeyedHistory:
    """A stored history: ``rows`` bucketed by ``key``, and ``hot`` with the keys that are too large for a bucket."""

    spark: SparkSession
    name: str
    key: str

    @cached_property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    @cached_property
    def hot(self) -> DataFrame:
        return self.spark.table(f"{self.name}_hot")

    def by_key(self, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` on both parts, for work in which rows of different keys never meet."""
        return work(self.rows).unionByName(work(self.hot))

    def whole(self) -> DataFrame:
        return self.rows.unionByName(self.hot)


def by_key(history: DataFrame | KeyedHistory, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return history.by_key(work) if isinstance(history, KeyedHistory) else work(history)


def whole(history: DataFrame | KeyedHistory) -> DataFrame:
    return history.whole() if isinstance(history, KeyedHistory) else history


def write_keyed(frame: DataFrame, name: str, key: str, by: str, buckets: int, folder: str) -> KeyedHistory:
    """Write ``frame`` as tables ``name`` and ``name``_hot below ``folder``, replacing older ones.

    A key is hot if it holds more than a bucket's fair share of the rows. At most ``2 * buckets`` keys are, found by a sketch.
    """
    spark = frame.sparkSession
    items = spark.range(0, 1, 1, 1).select(hot_keys(frame, key, buckets).alias("found")).first()["found"]
    many = F.col(f"`{key}`").isNull()
    if items:
        many = many | F.col(f"`{key}`").isin([x["item"] for x in items])
    few = frame.filter(~many).repartition(buckets, F.col(f"`{key}`"))
    few.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, by).option("path", f"{folder}/{name}").saveAsTable(name)
    frame.filter(many).write.mode("overwrite").option("path", f"{folder}/{name}_hot").saveAsTable(f"{name}_hot")
    return KeyedHistory(spark, name, key)


def write_dated(frame: DataFrame, folder: str, moment: str, unit: str = "day") -> None:
    """Write ``frame`` in one folder per ``unit`` of ``moment``, null among them. Rows of a period are split or joined to files of even size."""
    dated = frame.withColumn(PERIOD, F.date_trunc(unit, F.col(f"`{moment}`")).cast("date"))
    dated.hint("rebalance", F.col(PERIOD)).write.mode("overwrite").partitionBy(PERIOD).parquet(folder)


def from_dated(spark: SparkSession, folders: Mapping[str, str], as_of, days: int, until: int | None = None, unit: str = "day") -> Tables:
    """Dated tables, only the folders from ``days`` days before the day of ``as_of`` on (and to ``until`` days after it).

    For reports whose own look-back on the same column is no longer than that; their exact bounds still hold.
    """
    last = midnight(as_of)

    def opened(folder: str) -> DataFrame:
        rows = spark.read.parquet(folder)
        rows = rows.filter(F.col(PERIOD) >= F.lit(_first_day(last - timedelta(days=days), unit)))
        if until is not None:
            rows = rows.filter(F.col(PERIOD) <= F.lit(_first_day(last + timedelta(days=until), unit)))
        return rows.drop(PERIOD)

    return Tables({name: (lambda folder=folder: opened(folder)) for name, folder in folders.items()})


def _first_day(moment: datetime, unit: str) -> date:
    day = moment.date()
    return {"day": day, "month": day.replace(day=1), "year": day.replace(month=1, day=1)}[unit]
