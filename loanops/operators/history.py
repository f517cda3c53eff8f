"""Operators on history tables: many rows per entity, ordered by time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanops.operators.joins import ROWS, attach, per_key

# Column with a group's extreme value.
BEST = "__best"


def latest_row(frame: DataFrame, keys: Sequence[str], by: str, nulls_first: bool = True) -> DataFrame:
    """One row per key: the latest by ``by``; all other columns break ties, so the choice is repeatable.

    origin: SQL, where a null time sorts first in descending order. The rank filter plans as a group limit
    before the shuffle: a hot key sends one row per input partition, not its whole history.
    """
    order = F.col(by).desc_nulls_first() if nulls_first else F.col(by).desc_nulls_last()
    ties = [F.col(c).asc_nulls_last() for c in frame.columns if c not in (*keys, by)]
    window = Window.partitionBy(*keys).orderBy(order, *ties)
    return frame.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def with_group_value(frame: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Attach aggregates of its group to every row. Rows with a null key drop out, as in an inner self-join.

    Not a window: a window would pull a hot group into one task. Groups are aggregated before the shuffle
    and joined back.
    """
    return attach(frame, per_key(frame, keys, *[c.alias(name) for name, c in values.items()]), keys)


def with_group_min(frame: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return with_group_value(frame, keys, {name: F.min(value)})


def extremes(frame: DataFrame, keys: Sequence[str], by: str, which: str = "max") -> DataFrame:
    """Per group the extreme of ``by`` (null if it has no value) and its row count.

    Groups with a null key drop out.
    """
    best = F.max if which == "max" else F.min
    return frame.filter(_present(keys)).groupBy(*keys).agg(best(by).alias(BEST), F.count("*").alias(ROWS))


def rows_at(frame: DataFrame, best: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Rows of ``frame`` at their group's extreme, ties kept; a null extreme keeps the rows without value.

    The join is on group and value together, so only equal rows meet in one partition, and as the extremes
    are partitioned by group alone both sides are exchanged: the adaptive skew join can split it.
    """
    side = best.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)], BEST)
    condition = frame[by].eqNullSafe(side[BEST])
    for i, key in enumerate(keys):
        condition = condition & (frame[key] == side[f"__g{i}"])
    return frame.join(side, condition, "inner").select(*frame.columns)


def keep_extreme(frame: DataFrame, keys: Sequence[str], by: str, which: str = "max") -> DataFrame:
    """Rows at the extreme of ``by`` in their group, ties kept.

    origin: pandas. Groups with a null key drop out; a group without any value keeps all of its rows.
    """
    return rows_at(frame, extremes(frame, keys, by, which), keys, by)


def group_max_rows(frame: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """origin: SQL. Rows whose ``by`` equals the maximum of their group, ties kept; a null never equals."""
    return keep_extreme(frame.filter(F.col(by).isNotNull()), keys, by, "max")


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_state_times(
    history: DataFrame, key: str, state: str, at: str, wanted: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per key, the first time it entered any of a set of states; all sets in one pass over the history."""
    union = sorted({s for states in wanted.values() for s in states})
    return (
        history.filter(F.col(state).isin(*union))
        .groupBy(key)
        .agg(*[F.min(F.when(F.col(state).isin(*states), F.col(at))).alias(name) for name, states in wanted.items()])
    )


def next_after(
    history: DataFrame,
    key: str,
    state: str,
    at: str,
    after: str,
    wanted: str,
    name: str = "next_on",
) -> DataFrame:
    """Per key, the first time in state ``wanted`` strictly after the last time in state ``after``."""
    is_wanted = F.col(state) == wanted
    last = per_key(history.filter(F.col(state) == after), [key], F.max(at).alias("__after"))
    later = history.filter(is_wanted).select(key, at)
    return (
        attach(later, last, [key])
        .filter(F.col(at) > F.col("__after"))
        .groupBy(key)
        .agg(F.min(at).alias(name))
    )
