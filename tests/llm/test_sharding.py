from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loanops.llm import sharding

from .conftest import documents, prose


def placed(docs, shards=8, **more):
    frame = sharding.shard_documents(docs, shards, **more)
    names = frame.columns[-2:]
    return frame.select("doc_id", "text", F.col(names[0]).alias("at"), F.col(names[1]).alias("place")).collect()


def check(rows, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["at"], []).append(r["place"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(0 <= k < shards for k in by_shard)


def sizes(rows, shards):
    return [sum(len((r["text"] or "").encode()) + 1 for r in rows if r["at"] == k) for k in range(shards)]


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows are copies of one text."""
    rows = [(i, prose(i, 20 + i % 50), "en", "s") for i in range(900)] + [(10_000 + i, prose(7, 60), "en", "s") for i in range(500)]
    return documents(spark, rows)


def test_sizes_are_near_equal_although_a_group_is_hot(hot):
    rows = placed(hot)
    check(rows, 8)
    own = sizes(rows, 8)
    share = sum(own) / 8
    assert len(rows) == 1400 and max(abs(s - share) for s in own) <= 0.02 * share + 600


def test_small_groups_stay_together(spark):
    rows = [(i, prose(i // 3, 60), "en", "s") for i in range(1500)]
    at = {}
    for r in placed(documents(spark, rows)):
        at.setdefault(r["text"], set()).add(r["at"])
    assert sum(len(v) > 1 for v in at.values()) <= 7


def test_splitters_count_exact_bytes(spark, hot):
    first, second = sharding.sort_key(F.col("doc_id"), F.col("text"))
    keys = hot.select(first.alias("first"), second.alias("second"), sharding.byte_size(F.col("text")).alias("size")).cache()
    splitters = sharding.find_splitters(keys, 4, 0.001)
    rows = keys.collect()
    total = sum(r["size"] for r in rows)
    for j, s in enumerate(splitters, 1):
        below = sum(r["size"] for r in rows if (r["first"], r["second"]) < tuple(s))
        biggest = max(r["size"] for r in rows)
        assert abs(below - total * j / 4) <= max(biggest, 0.001 * total / 4)


def test_same_result_for_other_partitions(hot):
    one = {(r["doc_id"], r["at"], r["place"]) for r in placed(hot)}
    assert one == {(r["doc_id"], r["at"], r["place"]) for r in placed(hot.repartition(13))}


def test_defined_cases(spark, tricky, nothing):
    rows = placed(tricky, 3)
    check(rows, 3)
    assert len(rows) == tricky.count()
    assert placed(nothing) == []
    assert {r["at"] for r in placed(tricky, 1)} == {0}
    one = documents(spark, [(1, "x", "en", "s")] * 5)
    check(placed(one), 8)
    assert set(tricky.columns) < set(sharding.shard_documents(tricky).columns)


def test_plan_is_native(tricky):
    plan = sharding.shard_documents(tricky)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
