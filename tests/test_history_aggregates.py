from __future__ import annotations

import statistics
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanops.operators import aggregates, history
from tests.conftest import at, rows_of

D = "2024-01-{:02d} 00:00:00".format


def test_latest_row_puts_missing_times_first(make):
    frame = make("k int, x ts, v int", [(1, at(D(1)), 5), (1, None, 6), (2, at(D(2)), 8), (2, at(D(2)), 7)])
    assert rows_of(history.latest_row(frame, ["k"], "x").select("k", "v")) == [(1, 6), (2, 7)]
    assert rows_of(history.latest_row(frame, ["k"], "x", nulls_first=False).select("k", "v")) == [(1, 5), (2, 7)]


def test_latest_row_is_limited_before_the_shuffle(make):
    frame = make("k int, x ts, v int", [(1, at(D(1)), 5)])
    plan = history.latest_row(frame, ["k"], "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_extreme(make):
    rows = [
        ("a", at(D(3)), 1),
        ("a", at(D(3)), 2),
        ("a", at(D(1)), 3),
        ("a", None, 4),
        ("b", None, 5),
        ("b", None, 6),
        (None, at(D(9)), 7),
    ]
    frame = make("p string, x ts, v int", rows)
    assert rows_of(history.keep_extreme(frame, ["p"], "x", "max").select("v")) == [(1,), (2,), (5,), (6,)]
    assert rows_of(history.keep_extreme(frame, ["p"], "x", "min").select("v")) == [(3,), (5,), (6,)]
    assert rows_of(history.group_max_rows(frame, ["p"], "x").select("v")) == [(1,), (2,)]


def test_group_min_equals_self_join(make):
    frame = make("k int, x ts, v int", [(1, at(D(4)), 1), (1, at(D(2)), 2), (2, None, 3), (None, at(D(1)), 4)])
    plain = frame.join(frame.groupBy("k").agg(F.min("x").alias("low")), "k").select("k", "x", "v", "low")
    ours = history.with_group_min(frame, ["k"], "x", "low").select("k", "x", "v", "low")
    assert rows_of(ours) == rows_of(plain)


def test_next_after_is_strict(make):
    rows = [
        ("a", "RUN", at(D(1))),
        ("a", "DONE", at(D(2))),
        ("a", "RUN", at(D(3))),
        ("a", "DONE", at(D(3))),
        ("a", "DONE", at(D(5))),
        ("a", "DONE", at(D(4))),
        ("b", "RUN", at(D(3))),
        ("b", "DONE", at(D(2))),
        ("c", "DONE", at(D(2))),
    ]
    frame = make("k string, s string, x ts", rows)
    out = history.next_after(frame, "k", "s", "x", "RUN", "DONE")
    assert rows_of(out) == [("a", at(D(4)))]


def test_first_state_times_in_one_pass(make):
    rows = [("a", "S1", at(D(3))), ("a", "S2", at(D(2))), ("a", "S1", at(D(1))), ("b", "S9", at(D(1))), ("c", "S2", at(D(7)))]
    frame = make("k string, s string, x ts", rows)
    out = history.first_state_times(frame, "k", "s", "x", {"any": ("S1", "S2"), "second": ("S2",)})
    assert rows_of(out) == [("a", at(D(1)), at(D(2))), ("c", at(D(7)), at(D(7)))]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.floats(-1e7, 1e7, width=32), st.sampled_from([0.0, 0.5, -0.5, 25000.0, 24999.99])),
        ),
        max_size=40,
    )
)
def test_median_matches_brute_force(make, rows):
    groups = defaultdict(list)
    for key, value in rows:
        if value is not None:
            groups[key].append(value)
    frame = make("k string, v double", rows)
    got = {r["k"]: r["median"] for r in aggregates.exact_median(frame, ["k"], "v").collect()}
    assert got == {k: pytest.approx(statistics.median(v)) for k, v in groups.items()}


def test_median_of_one_hot_group(spark):
    frame = spark.range(20001).select(F.lit("x").alias("k"), ((F.col("id") * 7919) % 20001 / 100).alias("v"))
    assert aggregates.exact_median(frame, ["k"], "v").first()["median"] == 100.0


@pytest.mark.parametrize("value", ["id / 2e8", "1.7e9 + id / 1e6", "-id", "id % 3", "if(id % 2 = 0, double('nan'), id)", "if(id = 5, double('inf'), id)"])
def test_median_of_hard_values_in_one_group(spark, value):
    frame = spark.range(20000, numPartitions=6).selectExpr("'x' as k", f"double({value}) as v")
    known = sorted(r["v"] for r in frame.collect() if r["v"] == r["v"])
    assert aggregates.exact_median(frame, ["k"], "v").first()["median"] == statistics.median(known)


def _brackets(frame, rounds):
    """How many different values each round leaves."""
    rows, left = frame.select(F.struct("k").alias("__k"), F.col("v").alias("__v")), []
    added = [F.count("*").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high")]
    found = aggregates._picked(rows.groupBy("__k", aggregates._octaves(F.col("__v"), aggregates.COARSE).alias("__slot")).agg(*added), [], False)
    for _ in range(rounds):
        inside = aggregates._inside(rows, found)
        left.append(inside.select("__v").distinct().count())
        carried = [F.first(c).alias(c) for c in ("__total", "__before", "__next", "__o__n")]
        found = aggregates._picked(inside.groupBy("__k", aggregates._steps().alias("__slot")).agg(*added, *carried), [], True)
    return left


@pytest.mark.parametrize("value", ["xxhash64(id) / 1e9", "id / 1e300", "1e9 + id / 1e6", "exp((xxhash64(id) % 1000) / 2.0)", "-1 - id / 1e12"])
def test_rounds_leave_few_values_of_a_hot_group(spark, value):
    frame = spark.range(200_000, numPartitions=8).selectExpr("'x' as k", f"double({value}) as v")
    assert _brackets(frame, 2)[1] <= 10
    known = sorted(r["v"] for r in frame.collect())
    assert aggregates.exact_median(frame, ["k"], "v").first()["median"] == statistics.median(known)


def test_slots_never_fall(spark):
    values = sorted({s * m * 2.0**e for s in (-1, 1) for e in (-1074, -1022, -1021, -3, -1, 0, 1, 52, 1023) for m in (0.0, 1.0, 1.0000001, 1.4999, 1.9999999999999998)})
    values = [float("-inf"), *values, float("inf")]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v double").select("i", "v", aggregates._octaves(F.col("v"), 8).alias("s"))
    slots = [r["s"] for r in frame.orderBy("i").collect()]
    assert slots == sorted(slots)


def test_median_and_sums_with_null_values_and_keys(make):
    frame = make("k string, v double, w int", [("a", None, 1), ("a", None, 2), (None, 3.0, 4), (None, 5.0, None)])
    got = aggregates.median_and_sums(frame, ["k"], "v", ["w"], "m")
    assert rows_of(got) == sorted([("a", None, 2, 3, 2), (None, 4.0, 2, 4, 1)], key=repr)


def test_distinct_counts(make):
    rows = [("d", 1, "u", "ok"), ("d", 1, "u", "bad"), ("d", 2, None, "ok"), ("d", None, "w", None), ("e", None, None, "ok"), (None, 3, "u", "ok")]
    frame = make("g string, a int, b string, s string", rows)
    spec = {"a_all": ("a", None), "a_ok": ("a", F.col("s") == "ok"), "b_all": ("b", None), "b_bad": ("b", F.col("s") == "bad")}
    plain = frame.groupBy("g").agg(
        F.count_distinct("a").alias("a_all"),
        F.count_distinct(F.when(F.col("s") == "ok", F.col("a"))).alias("a_ok"),
        F.count_distinct("b").alias("b_all"),
        F.count_distinct(F.when(F.col("s") == "bad", F.col("b"))).alias("b_bad"),
    )
    assert rows_of(aggregates.distinct_counts(frame, ["g"], spec)) == rows_of(plain)


def test_counts_and_flags(make):
    frame = make("g string, a int, b string", [("x", 1, None), ("x", None, "q"), (None, 1, "q")])
    assert rows_of(aggregates.count_columns(frame, ["g"])) == [("x", 1, 1)]
    flags = frame.groupBy("g").agg(aggregates.flag_any(F.col("b") == "q").alias("f"), aggregates.mean("a").alias("m"))
    assert rows_of(flags) == [("x", "Y", 1.0), (None, "Y", 1.0)]
