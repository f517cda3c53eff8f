"""Joins.

Plain left/inner/semi joins are left to Catalyst: it broadcasts a side by its own size estimate, and the
adaptive skew join splits hot partitions of sort-merge joins. It cannot do that for full outer joins, for
the right side of left joins; ``spread_join`` covers those. Where one side is an aggregate on the join key, ``per_key``
gives that side an exchange of its own, so that the other one can be split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot if it holds more than one part in so many of its side's rows. By arithmetic no more than so many keys can, so the list
# of hot keys is bounded (twice that for estimated counts), and each cell of a hot key gets about one such part.
HOT_PARTS = 1000
# Column with the number of rows, in tables that stand for the keys of a larger one.
ROWS = "__n"


@dataclass(frozen=True)
class Dimension:
    """A lookup table with one row per key: ``take`` maps output names to its columns."""

    frame: DataFrame
    fact_key: str
    key: str
    take: Mapping[str, str]


def left_dims(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Left join ``fact`` to every dimension, projected to what is taken from it."""
    for number, dim in enumerate(dimensions):
        key = f"__dim{number}"
        side = dim.frame.select(F.col(dim.key).alias(key), *[F.col(c).alias(out) for out, c in dim.take.items()])
        fact = fact.join(side, fact[dim.fact_key] == side[key], "left").drop(key)
    return fact


def semi_ids(frame: DataFrame, ids: DataFrame, on: str, id_column: str) -> DataFrame:
    """Rows whose ``on`` occurs in ``ids``; an empty id table gives no rows."""
    side = ids.select(F.col(id_column).alias("__id")).filter(F.col("__id").isNotNull())
    return frame.join(side, frame[on] == side["__id"], "left_semi")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    hot: str = "both",
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """Equi-join (inner, left or full) in which no single task gets all rows of a hot key.

    Each hot key becomes a grid of cells: a left row goes to one grid row and is copied along it, a right
    row goes to one grid column and is copied along it, so every pair still meets exactly once. A row is copied only for a
    key that is hot, and so present, on the other side; a copy that meets nobody in its cell is dropped, because another one did.
    The list of hot keys is the only broadcast: at most ``2 * hot_parts`` keys for each side. Column names of the two sides must differ.

    Hot keys come from a heavy-hitter sketch: one pass over the keys of a side without any exchange of them. The sketch is evaluated once
    and both sides read its one result, so it does not matter that its counts are estimates.

    ``hot`` names the sides that may have many rows per key; only those are sketched. ``left_keys`` / ``right_keys``: a cheaper
    table to sketch instead. All its keys must be keys of the side. With a ``ROWS`` column it has one row per key, with
    its number of rows, and no sketch is needed.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if how not in ("inner", "left", "full") or hot not in ("left", "right", "both"):
        raise ValueError((how, hot))
    as_text = len(left_on) > 1 or not all(_sketched(f.schema[on[0]].dataType) for f, on in ((left, left_on), (right, right_on)))
    if as_text and [left.schema[c].dataType for c in left_on] != [right.schema[c].dataType for c in right_on]:
        raise ValueError("keys of this kind need the same types on both sides")
    found = {}
    if hot != "right":
        found["__rows"] = _hot_keys(left if left_keys is None else left_keys, left_on, as_text, hot_parts)
    if hot != "left":
        found["__cols"] = _hot_keys(right if right_keys is None else right_keys, right_on, as_text, hot_parts)
    marks = _marks(left.sparkSession, found)
    placed_left = _place(left, left_on, as_text, marks, own="__rows", other="__cols", copies=hot != "left", tag="l")
    placed_right = _place(right, right_on, as_text, marks, own="__cols", other="__rows", copies=hot != "right", tag="r")
    condition = (F.col("__l_own") == F.col("__r_other")) & (F.col("__l_other") == F.col("__r_own"))
    for a, b in zip(left_on, right_on):
        condition = condition & (placed_left[f"`{a}`"] == placed_right[f"`{b}`"])
    joined = placed_left.join(placed_right, condition, how)
    if how != "inner" and hot != "left":
        joined = joined.filter(~(F.col("__r_copied").isNull() & F.coalesce("__l_copied", F.lit(False))))
    if how == "full" and hot != "right":
        joined = joined.filter(~(F.col("__l_copied").isNull() & F.coalesce("__r_copied", F.lit(False))))
    return joined.select(*_named(left.columns), *_named(right.columns))


def hot_keys(frame: DataFrame, key: str, parts: int) -> Column:
    """Scalar array of (item, cells): the keys that hold more than one part in ``parts`` of the rows, at most twice as many."""
    return _hot_keys(frame, [key], False, parts)


def per_key(frame: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates per key, dealt out by a hash of the key as well.

    A join on the key alone then exchanges this side too, and only between two exchanged sides can the adaptive skew join
    split the rows of a hot key.
    """
    salt = F.xxhash64(*_named(keys)).alias("__salt")
    return frame.groupBy(*_named(keys), salt).agg(*aggregates).drop("__salt")


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` to ``groups``, one row per key from ``per_key``; its other columns are added to ``rows``."""
    values = [c for c in groups.columns if c not in keys]
    side = groups.select(*[F.col(f"`{k}`").alias(f"__g{i}") for i, k in enumerate(keys)], *_named(values))
    return rows.join(side, _equal(rows, keys, side, "__g")).select(*_named(rows.columns), *_named(values))


def full_coalesce(left: DataFrame, right: DataFrame, on: Sequence[str], merged: Sequence[str] = ()) -> DataFrame:
    """Full outer join of two tables with one row per key; keys and ``merged`` columns are taken left first."""
    side = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns})
    condition = reduce(lambda a, b: a & b, [left[f"`{key}`"] == side[f"`__r_{key}`"] for key in on])
    both = left.join(side, condition, "full")
    shared = [*on, *merged]
    return both.select(
        *[F.coalesce(F.col(f"`{c}`"), F.col(f"`__r_{c}`")).alias(c) for c in shared],
        *_named([c for c in left.columns if c not in shared]),
        *[F.col(f"`__r_{c}`").alias(c) for c in right.columns if c not in shared],
    )


def _sketched(kind: T.DataType) -> bool:
    """Types that the sketch can hold."""
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _item(frame: DataFrame, on: Sequence[str], as_text: bool) -> Column:
    """The key as one value, null if a part of it is."""
    if not as_text:
        return frame[f"`{on[0]}`"]
    # Adding 0 makes -0.0 equal to 0.0, as it is in a join.
    parts = [frame[f"`{c}`"] + F.lit(0.0) if isinstance(frame.schema[c].dataType, T.FractionalType) and not isinstance(frame.schema[c].dataType, T.DecimalType) else frame[f"`{c}`"] for c in on]
    present = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(present, F.to_json(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])))


def _hot_keys(frame: DataFrame, on: Sequence[str], as_text: bool, hot_parts: int) -> Column:
    """Array of (item, cells) of the keys that hold more than one part in ``hot_parts`` of the rows; evaluated once a query."""
    keys = frame.select(_item(frame, on, as_text).alias("item"), *([ROWS] if ROWS in frame.columns else [])).filter(F.col("item").isNotNull())
    if ROWS in keys.columns:
        total = keys.agg(F.sum(ROWS)).scalar()
        hot = keys.filter(F.col(ROWS) * hot_parts > total)
        return hot.agg(F.collect_list(F.struct("item", _cells(F.col(ROWS), total, hot_parts).alias("cells")))).scalar()
    # With so many items tracked, every key above the share is found, whatever the order of merging.
    top = F.call_function("approx_top_k", "item", F.lit(min(2 * hot_parts, 100_000)), F.lit(min(10 * hot_parts + 1000, 1_000_000)))
    found = keys.agg(top.alias("top"), F.count("item").alias("n"))
    cells = F.transform("top", lambda x: F.struct(x["item"].alias("item"), _cells(x["count"], F.col("n"), hot_parts).alias("cells")))
    return found.select(F.filter(cells, lambda x: x["cells"] > 1)).scalar()


def _cells(rows: Column, total: Column, hot_parts: int) -> Column:
    """One cell for each part of the rows that a key has, no more than it has rows."""
    return F.least(F.ceil(rows * F.lit(float(hot_parts)) / total), rows).cast("int")


def _marks(spark: SparkSession, found: Mapping[str, Column]) -> DataFrame:
    """(item, __rows, __cols): the cells of each hot key on its two sides."""
    one = spark.range(0, 1, 1, 1).select(*[array.alias(name) for name, array in found.items()])
    if len(found) == 1:
        (name,) = found
        return one.select(F.inline(name)).select("item", *[(F.col("cells") if n == name else F.lit(1)).alias(n) for n in ("__rows", "__cols")])

    def listed(name: str) -> Column:
        return F.transform(name, lambda x: F.struct(x["item"].alias("item"), *[(x["cells"] if n == name else F.lit(1)).alias(n) for n in found]))

    # One row for each key by grouping: to look each key up in the other side's array takes the product of their lengths.
    return one.select(F.inline(F.concat(*[listed(name) for name in found]))).groupBy("item").agg(*[F.max(n).alias(n) for n in found])


def _all_present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{name}`").isNotNull() for name in names])


def _spots(frame: DataFrame) -> int:
    """Places for rows that meet nobody by key: as many as the session shuffles into."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _named(columns: Sequence[str]) -> list[Column]:
    """Columns by their whole names, dots included."""
    return [F.col(f"`{c}`") for c in columns]


def _equal(frame: DataFrame, on: Sequence[str], marks: DataFrame, prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [frame[f"`{c}`"] == marks[f"{prefix}{i}"] for i, c in enumerate(on)])


def _hashables(frame: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in frame.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def _zero(frame: DataFrame, on: Sequence[str]) -> Column:
    """0 as a join key. A literal would be folded away, and the cells of the other side with it."""
    return F.pmod(F.hash(*[frame[f"`{c}`"] for c in on]), F.lit(1))


def _place(frame, on, as_text, marks, own, other, copies, tag) -> DataFrame:
    """Give each row its cell, and copy it along the other side's cells of a hot key."""
    item = f"__{tag}_item"
    side = marks.withColumnRenamed("item", item)
    # Content and input partition together: copies of one row spread too, and a retried task repeats the choice.
    spot = F.xxhash64(F.spark_partition_id(), *_hashables(frame))
    placed = frame.join(F.broadcast(side), _item(frame, on, as_text) == side[item], "left").select(
        *_named(frame.columns),
        F.when(F.col(own).isNotNull(), F.pmod(spot, F.col(own)))
        .when(~_all_present(on), F.pmod(spot, F.lit(_spots(frame))))
        .otherwise(0)
        .cast("int")
        .alias(f"__{tag}_own"),
        F.coalesce(F.col(other), F.lit(1)).alias("__span"),
    )
    placed = placed.withColumn(f"__{tag}_copied", F.col("__span") > 1)
    cell = F.explode(F.sequence(F.lit(0), F.col("__span") - 1)) if copies else _zero(frame, on)
    return placed.withColumn(f"__{tag}_other", cell).drop("__span")
