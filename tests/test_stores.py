"""Histories stored by key are read without an exchange; dated tables read only the folders of their window."""

from __future__ import annotations

import re
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from loanops.operators import history
from loanops.sources import stores
from tests.conftest import at, rows_of


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, some without key or time, and repeated rows."""
    ids = spark.range(6000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 41 == 1, None).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 2 == 0, "RUN").otherwise("DONE").alias("s"),
        F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.col("id") * 977 % 90_000).cast("timestamp_ntz")).alias("x"),
    )
    return ids.unionAll(ids.filter("k < 20"))


@pytest.fixture(scope="module")
def store(rows, tmp_path_factory):
    return stores.write_keyed(rows, f"h{uuid4().hex}", "k", "x", 8, str(tmp_path_factory.mktemp("keyed")))


def test_both_parts_hold_all_rows(rows, store):
    assert rows_of(store.whole().select("k", "s", "x")) == rows_of(rows)
    hot = {r["k"] for r in store.hot.select("k").distinct().collect()}
    assert {7, None} <= hot and len(hot) < 20
    assert not hot & {r["k"] for r in store.rows.select("k").distinct().collect()}


@pytest.mark.parametrize(
    "work",
    [
        lambda h: history.latest_row(h, ["k"], "x"),
        lambda h: h.groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("x")),
        lambda h: history.next_after(h, "k", "s", "x", "RUN", "DONE"),
        lambda h: history.first_state_times(h, "k", "s", "x", {"run": ["RUN"], "any": ["RUN", "DONE"]}),
    ],
)
def test_same_rows_as_from_the_plain_table(rows, store, work):
    assert rows_of(stores.by_key(store, work)) == rows_of(stores.by_key(rows, work))


@pytest.mark.parametrize("work", [lambda h: history.latest_row(h, ["k"], "x"), lambda h: h.groupBy("k").agg(F.max("x").alias("x"))])
def test_bucketed_part_needs_no_exchange(rows, store, work):
    plan = work(store.rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "Exchange" in work(rows)._jdf.queryExecution().executedPlan().toString()


def test_join_on_the_key_exchanges_the_other_side_only(spark, store):
    other = spark.range(300).withColumnRenamed("id", "k2")
    latest = history.latest_row(store.rows, ["k"], "x")
    plan = latest.hint("merge").join(other, latest["k"] == other["k2"])._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "Exchange" in line and "k2" not in line] == []


@pytest.mark.parametrize("unit,folders", [("day", 9), ("month", 3), ("year", 1)])
def test_dated_tables_read_the_window_only(spark, make, tmp_path, unit, folders):
    days = [at(f"2024-{m:02}-{d:02} 08:00:00") for m in range(1, 13) for d in (1, 9, 17, 25)] + [None]
    frame = make("i long, x ts", list(enumerate(days)) * 2)
    stores.write_dated(frame, f"{tmp_path}/t", "x", unit)
    since = F.lit("2024-10-21").cast("timestamp_ntz")
    t = stores.from_dated(spark, {"t": f"{tmp_path}/t"}, "2024-11-10 12:00:00", 20, unit=unit)
    assert rows_of(t["t"].filter(F.col("x") >= since)) == rows_of(frame.filter(F.col("x") >= since))
    found = t["t"]
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    assert re.search(r"PartitionFilters: \[isnotnull\(__period#\d+\), \(__period#\d+ >= 2024-", plan.toString())
    assert len({r[0].rsplit("/", 2)[-2] for r in found.select("_metadata.file_path").collect()}) == folders


def test_dated_window_with_an_end(spark, make, tmp_path):
    frame = make("i long, x ts", [(i, at(f"2024-03-{i:02} 23:59:59")) for i in range(1, 31)])
    stores.write_dated(frame, f"{tmp_path}/t", "x")
    t = stores.from_dated(spark, {"t": f"{tmp_path}/t"}, "2024-03-10 06:00:00", 2, until=1)
    assert sorted(r["i"] for r in t["t"].collect()) == [8, 9, 10, 11]
