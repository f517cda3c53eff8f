"""Distinct counts from bitmaps against plain ones, merged over coarser groups."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loanops.operators import bitmaps
from tests.conftest import rows_of

def _counts():
    ok = F.col("s") == "ok"
    return {"a_all": ("a", None), "a_ok": ("a", ok), "b_all": ("b", None), "b_bad": ("b", ~ok)}


def _plain(frame, keys):
    ok = F.col("s") == "ok"
    return frame.groupBy(*keys).agg(
        F.count_distinct("a").alias("a_all"),
        F.count_distinct(F.when(ok, F.col("a"))).alias("a_ok"),
        F.count_distinct("b").alias("b_all"),
        F.count_distinct(F.when(~ok, F.col("b"))).alias("b_bad"),
    )


def _rows(seed, n):
    draw = random.Random(seed)
    ids = [None, 0, 1, 2, 32767, 32768, 32769, 65536, 10**12, -1, -32768, 7, 7, 7]
    return [
        (draw.choice(["x", "y", "z", None]), draw.choice(["p", "q"]), draw.choice(ids), draw.choice(ids), draw.choice(["ok", "bad", None])) for _ in range(n)
    ]


def test_counts_of_the_finest_and_of_coarser_groups(make):
    for seed, n in ((1, 0), (2, 5), (3, 300)):
        frame = make("g string, h string, a long, b int, s string", [(g, h, a, b if b is None or abs(b) < 2**31 else 5, s) for g, h, a, b, s in _rows(seed, n)])
        state = bitmaps.distinct_state(frame, ["g", "h"], _counts())
        for keys in (["g", "h"], ["g"], ["h"]):
            assert rows_of(bitmaps.merged_counts(state, keys, list(_counts()))) == rows_of(_plain(frame, keys))


def test_hot_group_is_combined_before_the_shuffle(spark):
    frame = spark.range(200_000, numPartitions=8).select(F.lit("x").alias("g"), (F.col("id") % 50_000).alias("a"))
    state = bitmaps.distinct_state(frame, ["g"], {"n": ("a", None)})
    assert state.count() <= 3
    assert bitmaps.merged_counts(state, ["g"], ["n"]).first()["n"] == 50_000


def test_dense_ids(make):
    frame = make("v string, w long", [("b", 1), ("a", 2), (None, 3), ("b", 4), ("", 5)])
    assert rows_of(bitmaps.with_dense_ids(frame, "v", "n")) == sorted([("b", 1, 2), ("a", 2, 1), (None, 3, None), ("b", 4, 2), ("", 5, 0)], key=repr)
