"""Exact distinct counts as bitmaps that merge: counted once for the finest groups, then combined for coarser ones.

A state has one row per (group, id column, range of 32,768 ids), with one bitmap of 4 KB for each count, so it suits whole-numbered ids that lie close
together; ``with_dense_ids`` numbers any others. Rows become bits before the shuffle, so a hot group sends one row per
range and task, and a group of any size needs one task per range, not one for all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanops.sources.sinks import with_row_number

_KIND, _RANGE = "__kind", "__range"


def with_dense_ids(frame: DataFrame, column: str, name: str) -> DataFrame:
    """``frame`` with its different values of ``column`` numbered from 0 as ``name``; null stays null. Runs a job."""
    values = frame.select(F.col(f"`{column}`").alias("__value")).filter(F.col("__value").isNotNull()).distinct()
    numbers = with_row_number(values, ["__value"], name)
    return frame.join(numbers, F.col(f"`{column}`") == F.col("__value"), "left").drop("__value")


def distinct_state(frame: DataFrame, keys: Sequence[str], counts: Mapping[str, tuple[str, Column | None]]) -> DataFrame:
    """The state of conditional distinct counts per group: ``{output: (whole-numbered id column, condition or None)}``."""
    kinds = list(dict.fromkeys(column for column, _ in counts.values()))
    flags = {name: F.lit(True) if test is None else F.coalesce(test, F.lit(False)) for name, (_, test) in counts.items()}
    ids = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"`{kind}`").cast("long").alias("id")) for kind in kinds])
    rows = frame.select(*keys, *[flag.alias(f"__{name}") for name, flag in flags.items()], F.explode(ids).alias("__id"))
    # A group without ids keeps a row, with empty bitmaps.
    place = F.when(F.col("__id.id").isNotNull(), F.bitmap_bit_position(F.col("__id.id")))
    return rows.groupBy(*keys, F.col("__id.kind").alias(_KIND), F.bitmap_bucket_number(F.col("__id.id")).alias(_RANGE)).agg(
        *[
            F.bitmap_construct_agg(F.when(F.col(f"__{name}") & (F.col("__id.kind") == kind), place)).alias(name)
            for name, (kind, _) in counts.items()
        ]
    )


def merged_counts(state: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts of the groups of ``keys``, which may be coarser than those of the state."""
    merged = state.groupBy(*keys, _KIND, _RANGE).agg(*[F.bitmap_or_agg(name).alias(name) for name in names])
    return merged.groupBy(*keys).agg(*[F.sum(F.bitmap_count(name)).alias(name) for name in names])
