"""Every registered query against its DuckDB text on the smallest given tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from workload import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.QUERIES, entry_point.ORACLES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|EvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert compare.difference(frame, duck, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == [
        "created_on_date",
        "settled_under_time",
        "time_delay_till_today",
        "delay_in_settlement",
        "count",
    ]
    assert frame.count() > 0
