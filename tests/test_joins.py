"""Skew-spreading joins against plain joins, with limits low enough that most keys are hot."""

from __future__ import annotations

import itertools
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanops.operators import joins
from loanops.operators.history import rows_at, extremes
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows and half of the right rows have one key; copies, nulls, lonely keys on both sides."""
    left = spark.range(600, numPartitions=6).select(
        F.col("id").alias("a"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 23).alias("k"),
    )
    left = left.unionAll(left.filter("a < 90").withColumn("a", F.lit(-1).cast("long")))
    right = spark.range(120, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40 + 10).alias("r"),
        (F.col("id") % 13).alias("b"),
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("hot_parts", [1, 20, 10**6])
def test_both_sides_hot(sides, how, hot_parts):
    left, right = sides
    plain = left.join(right, left["k"] == right["r"], how).select("a", "k", "r", "b")
    spread = joins.spread_join(left, right, ["k"], ["r"], how, hot_parts=hot_parts).select("a", "k", "r", "b")
    assert rows_of(spread) == rows_of(plain)


@pytest.mark.parametrize("how,hot,hot_parts", list(itertools.product(["inner", "left", "full"], ["left", "right"], [20, 10**6])))
def test_one_side_hot(sides, how, hot, hot_parts):
    left, right = sides
    if hot == "left":
        right = right.filter("r is not null").groupBy("r").agg(F.max("b").alias("b"))
    else:
        left = left.filter("k is not null").groupBy("k").agg(F.max("a").alias("a")).select("a", "k")
    plain = left.join(right, left["k"] == right["r"], how).select("a", "k", "r", "b")
    spread = joins.spread_join(left, right, ["k"], ["r"], how, hot=hot, hot_parts=hot_parts).select("a", "k", "r", "b")
    assert rows_of(spread) == rows_of(plain)


def test_key_table_with_counts_too_high(sides):
    left, right = sides
    counts = left.groupBy("k").agg((F.count("*") * 5).alias(joins.ROWS))
    plain = left.join(right, left["k"] == right["r"], "full").select("a", "k", "r", "b")
    spread = joins.spread_join(left, right, ["k"], ["r"], "full", left_keys=counts, hot_parts=30)
    assert rows_of(spread.select("a", "k", "r", "b")) == rows_of(plain)


def test_hot_keys_need_no_exchange_of_keys(sides):
    """The sketch meets in one row a task, and both sides read one result of it."""
    left, right = sides
    joins.spread_join(left, right, ["k"], ["r"], "full").collect()
    plan = joins.spread_join(left, right, ["k"], ["r"], "full")._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan and "SinglePartition" in plan
    keyed = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keyed and all("__l_own" in line or "__r_own" in line for line in keyed)


def test_sketch_finds_every_key_above_the_share(spark):
    """Keys just above one part in a thousand, among many that are rare, in any order of merging."""
    hot = spark.range(0, 40 * 130, 1, 13).select((F.col("id") % 40).alias("k"))
    rows = hot.unionAll(spark.range(100, 95_000, 1, 17).select(F.col("id").alias("k"))).repartition(11)
    found = spark.range(1).select(joins._hot_keys(rows, ["k"], False, 1000).alias("a")).first()["a"]
    assert {x["item"] for x in found} >= set(range(40)) and len(found) <= 2000


def test_marks_of_many_keys(spark):
    """Two long lists of hot keys are merged in time that grows with their length, not with its square."""
    n = 40_000

    def listed(first, last):
        return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda x: F.struct(x.alias("item"), (x % 7 + 2).cast("int").alias("cells")))

    start = time.monotonic()
    marks = joins._marks(spark, {"__rows": listed(1, n), "__cols": listed(n // 2 + 1, n + n // 2)})
    found = marks.agg(F.count("*"), F.sum("item"), F.sum("__rows"), F.sum("__cols")).first()
    items = range(1, n + n // 2 + 1)
    rows, cols = sum(x % 7 + 2 if x <= n else 1 for x in items), sum(x % 7 + 2 if x > n // 2 else 1 for x in items)
    assert tuple(found) == (len(items), sum(items), rows, cols)
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("kind", ["string", "double", "decimal(20,3)", "date", "timestamp_ntz", "binary", "struct<a:bigint,b:string>"])
def test_key_types(spark, sides, kind):
    left, right = sides

    def cast(name):
        key = F.col(name)
        if kind.startswith("struct"):
            return F.when(key.isNotNull(), F.struct(key.alias("a"), key.cast("string").alias("b")))
        if kind in ("date", "timestamp_ntz"):
            return F.date_add(F.lit("2024-01-01").cast("date"), key.cast("int")).cast(kind)
        if kind == "binary":
            return key.cast("string").cast("binary")
        # -0.0 and 0.0 are one key.
        return F.when(key == 7, F.lit(-0.0 if name == "k" else 0.0)).otherwise(key.cast("double")) if kind == "double" else key.cast(kind)

    left, right = left.select("a", cast("k").alias("k")), right.select(cast("r").alias("r"), "b")
    plain = left.join(right, left["k"] == right["r"], "full").select("a", "k", "r", "b")
    spread = joins.spread_join(left, right, ["k"], ["r"], "full", hot_parts=20)
    assert rows_of(spread) == rows_of(plain)


def test_two_keys(sides):
    left, right = sides
    left = left.withColumn("k2", F.col("a") % 2)
    right = right.withColumn("r2", F.col("b") % 2)
    condition = (left["k"] == right["r"]) & (left["k2"] == right["r2"])
    plain = left.join(right, condition, "full")
    spread = joins.spread_join(left, right, ["k", "k2"], ["r", "r2"], "full", hot_parts=100)
    assert rows_of(spread) == rows_of(plain)


@pytest.fixture
def shuffled(spark):
    """No broadcast of the joined sides by size, no merging of small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _spread(frame, column):
    """Output partitions per key; all columns are read, so that the optimizer cannot drop the other side."""
    parts = defaultdict(set)
    for row in frame.withColumn("part", F.spark_partition_id()).collect():
        parts[row[column]].add(row["part"])
    return {key: len(found) for key, found in parts.items()}


@pytest.mark.parametrize("hot", ["left", "both"])
def test_hot_and_null_keys_land_in_many_partitions(sides, shuffled, hot):
    left, right = sides
    right = right.filter("r is not null").groupBy("r").agg(F.max("b").alias("b"))
    plain = _spread(left.join(right, left["k"] == right["r"], "left"), "k")
    assert plain[7] == plain[None] == 1
    parts = _spread(joins.spread_join(left, right, ["k"], ["r"], "left", hot=hot, hot_parts=20), "k")
    assert parts[7] > 4 and parts[None] > 4 and parts[5] == 1


def test_hot_right_rows_land_in_many_partitions(sides, shuffled):
    left, right = sides
    left = left.groupBy("k").agg(F.max("a").alias("a")).select("a", "k")
    left = left.unionAll(left.sparkSession.range(200).select("id", F.lit(None).cast("long")))
    parts = _spread(joins.spread_join(left, right, ["k"], ["r"], "left", hot="right", hot_parts=20), "k")
    assert parts[7] > 4 and parts[None] > 4


def test_same_column_on_both_sides_is_refused(sides):
    with pytest.raises(ValueError):
        joins.spread_join(sides[0], sides[0], ["k"], ["k"])


def test_attach(sides):
    left, _ = sides
    groups = joins.per_key(left, ["k"], F.min("a").alias("low"), F.max("a").alias("high")).filter("k is null or k <> 5")
    plain = left.join(groups, "k").select("a", "k", "low", "high")
    assert rows_of(joins.attach(left, groups, ["k"])) == rows_of(plain)


def test_attach_keeps_groups_with_null_values(make):
    rows = make("k long, v long", [(1, None), (1, None), (2, 3)])
    groups = joins.per_key(rows, ["k"], F.max("v").alias("top"))
    assert rows_of(joins.attach(rows, groups, ["k"])) == [(1, None, None), (1, None, None), (2, 3, 3)]


def test_names_with_dots(make):
    left = make("`a.k` long, `a.v` long", [(1, 10), (2, 20)])
    right = make("`b.k` long, `b.w` long", [(1, 5), (3, 6)])
    for parts in (1, 10**6):
        both = joins.spread_join(left, right, ["a.k"], ["b.k"], "full", hot_parts=parts)
        assert rows_of(both) == [(1, 10, 1, 5), (2, 20, None, None), (None, None, 3, 6)]
    groups = joins.per_key(left, ["a.k"], F.max("`a.v`").alias("top.v"))
    assert rows_of(joins.attach(left, groups, ["a.k"])) == [(1, 10, 10), (2, 20, 20)]


def test_no_more_hot_keys_than_parts(spark):
    """A key is hot by its share of the rows, whatever their number."""
    frame = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    counts = joins.per_key(frame, ["k"], F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    assert counts.filter(F.col("n") * 2 > total).count() == 0 and counts.filter(F.col("n") * 4 > total).count() == 3


def test_left_dims_and_semi(make):
    fact = make("id long, k long", [(1, 10), (2, None), (3, 99)])
    dim = make("key long, name string", [(10, "x"), (11, "y")])
    out = joins.left_dims(fact, [joins.Dimension(dim, "k", "key", {"name": "name"})])
    assert rows_of(out) == [(1, 10, "x"), (2, None, None), (3, 99, None)]
    assert rows_of(joins.semi_ids(fact, dim, "k", "key")) == [(1, 10)]
    assert rows_of(joins.semi_ids(fact, dim.limit(0), "k", "key")) == []


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _hot_person(spark):
    return spark.range(30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("person"),
        F.least(F.col("id"), F.lit(0)).alias("at"),
        F.xxhash64("id").alias("id"),
    )


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_adaptive_skew_split_of_group_extremes(spark, skew_settings):
    """The join on group and value is one that the adaptive skew join can split, also before an aggregate."""
    frame = _hot_person(spark)
    kept = rows_at(frame, extremes(frame, ["person"], "at"), ["person"], "at")
    assert kept.count() == 30000
    assert "skew=true" in _final_plan(kept)
    assert "skew=true" in _final_plan(kept.groupBy("person", "at").agg(F.max("id")))


def test_adaptive_skew_split_of_attached_groups(spark, skew_settings):
    frame = _hot_person(spark)
    groups = joins.per_key(frame, ["person"], F.min("id").alias("low"))
    assert "skew=true" in _final_plan(joins.attach(frame, groups, ["person"]))


def test_adaptive_skew_split_of_dimension_joins(spark, skew_settings):
    fact = _hot_person(spark)
    dim = spark.range(40000, numPartitions=4).select(F.col("id").alias("key"), F.xxhash64("id").alias("name"))
    joined = joins.left_dims(fact, [joins.Dimension(dim, "person", "key", {"name": "name"})])
    assert "skew=true" in _final_plan(joined)
