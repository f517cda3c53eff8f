"""Aggregates whose built-in form would gather a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slots of the first histogram for each octave, and of each later one for the slot found before.
COARSE, FINE = 1 << 3, 1 << 20
_LARGEST, _LEAST_OCTAVE = 1.7e308, -1022


def exact_median(frame: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group, nulls and NaN ignored; groups without any value are absent."""
    return median_and_sums(frame, keys, value, (), name).filter(F.col(name).isNotNull()).select(*[F.col(f"`{k}`") for k in keys], name)


def median_and_sums(
    frame: DataFrame, keys: Sequence[str], value: str, summed: Sequence[str], name: str = "median", coarse: int = COARSE, rounds: int = 2
) -> DataFrame:
    """Exact median per group (null without values), ``rows``, and of each column in ``summed`` its ``sum_`` and ``count_``.

    The built-in median keeps a map of all distinct values of a group in one task. Here ranks are counted below candidate values until
    the bracket of the median is small. Each round counts a group's rows in slots of a monotone scale, ``coarse`` slots an octave
    first, then ``FINE`` equal steps inside the slot found, and a running sum over the slots finds the one of the median. The values in the
    last one are counted and ranked. So no task gets a group's rows, only numbers of slots, which are combined before each shuffle:
    after two rounds a group of 10^12 different values has some ten thousand left. NaN counts as no value.

    Every round reads ``frame`` anew, with the same columns, so Spark computes the exchanges below it once. Where that is slow to plan,
    one round of many slots does: with 2^14 an octave, amounts of money below a hundred million leave less than a million.
    """
    number = F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None).cast("double"))
    named = {f"__s{i}": F.col(f"`{c}`") for i, c in enumerate(summed)}
    rows = frame.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("__k"), number.alias("__v"), *[c.alias(n) for n, c in named.items()])
    sums = [total for n in named for total in (n, f"__c{n}")]
    added = [F.count("*").alias("__n"), *[a for n in named for a in (F.sum(n).alias(n), F.count(n).alias(f"__c{n}"))]]
    shape = [F.min("__v").alias("__low"), F.max("__v").alias("__high")]
    carried = [F.first(c).alias(c) for c in ("__total", "__before", "__next", *[f"__o{n}" for n in ("__n", *sums)])]
    found = _picked(rows.groupBy("__k", _octaves(F.col("__v"), coarse).alias("__slot")).agg(*added, *shape), sums, False)
    for _ in range(rounds - 1):
        found = _picked(_inside(rows, found).groupBy("__k", _steps().alias("__slot")).agg(*added, *shape, *carried), sums, True)
    group = Window.partitionBy("__k").orderBy("__v")
    last = _inside(rows, found).groupBy("__k", "__v").agg(*added, *carried)
    last = last.withColumn("__upto", F.col("__before") + F.sum(F.when(F.col("__v").isNull(), 0).otherwise(F.col("__n"))).over(group))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__upto") - F.col("__n") < rank) & (rank <= F.col("__upto")), F.col("__v")))

    first, second = _middle()
    result = last.groupBy("__k").agg(
        ((at(first) + F.coalesce(at(second), F.first("__next"))) / 2).alias(name),
        *[_plus(F.sum(n), F.first(f"__o{n}")).alias(n) for n in ("__n", *sums)],
    )
    return result.select(
        *[F.col(f"__k.`{k}`").alias(k) for k in keys],
        name,
        F.col("__n").alias("rows"),
        *[F.col(n).alias(f"sum_{c}") for n, c in zip(named, summed)],
        *[F.col(f"__c{n}").alias(f"count_{c}") for n, c in zip(named, summed)],
    )


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a missing part counts as nothing."""
    return F.coalesce(a + b, a, b)


def _middle() -> tuple[Column, Column]:
    return F.floor((F.col("__total") + 1) / 2), F.floor(F.col("__total") / 2) + 1


def _octaves(v: Column, coarse: int) -> Column:
    """A slot number that never falls as ``v`` grows: so many steps of equal width between powers of two."""
    size = F.least(F.abs(v), F.lit(_LARGEST))
    octave = F.greatest(F.floor(F.log2(size)), F.lit(_LEAST_OCTAVE))
    steps = F.floor((octave - _LEAST_OCTAVE + size / F.pow(F.lit(2.0), octave)) * coarse)
    return F.when(v < 0, -steps).when(v >= 0, steps)


def _steps() -> Column:
    """Number of one of ``FINE`` equal steps from the lowest to the highest value of the bracket."""
    v, low, high = (F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2 for c in ("__v", "__from", "__to"))
    return F.floor((v - low) / F.nullif(high - low, F.lit(0.0)) * FINE)


def _picked(slots: DataFrame, sums: Sequence[str], narrowed: bool) -> DataFrame:
    """Per group the slot with the first of the middle ranks: its lowest and highest value, the number of values below it, the lowest
    value above it, and what the rows outside of it add up to. A group without values has the slot of its null.

    ``narrowed``: the slots are those of an earlier slot, whose numbers they carry.
    """
    group = Window.partitionBy("__k")
    known = F.when(F.col("__low").isNull(), 0).otherwise(F.col("__n"))
    upto = F.sum(known).over(group.orderBy("__slot"))
    if narrowed:
        slots = slots.withColumn("__upto", F.col("__before") + upto)
    else:
        slots = slots.withColumns({"__total": F.sum(known).over(group), "__upto": upto})
    below = F.col("__upto") - known
    first, _ = _middle()
    chosen = F.when(F.col("__total") == 0, F.lit(True)).otherwise((below < first) & (first <= F.col("__upto")) & F.col("__low").isNotNull())
    above = F.min(F.when(below >= first, F.col("__low")))
    outside = {f"__o{n}": F.sum(F.when(~chosen, F.col(n))) for n in ("__n", *sums)}
    # The salt is for joins on the group, see ``per_key``.
    picked = slots.groupBy("__k", F.xxhash64("__k").alias("__salt")).agg(
        F.first("__total").alias("__total"),
        *[F.max(F.when(chosen, F.col(c))).alias(n) for c, n in (("__low", "__from"), ("__high", "__to"))],
        F.max(F.when(chosen, below)).alias("__before"),
        (F.least(above, F.first("__next")) if narrowed else above).alias("__next"),
        *[(_plus(total, F.first(o)) if narrowed else total).alias(o) for o, total in outside.items()],
    )
    return picked.drop("__salt")


def _inside(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows in the bracket of their group.

    Every group is in ``found``; the left join tells Spark which side is the small one.
    """
    side = found.withColumnRenamed("__k", "__g")
    empty = (F.col("__total") == 0) & F.col("__v").isNull()
    inside = F.col("__v").between(F.col("__from"), F.col("__to")) | empty
    return rows.join(side, rows["__k"] == side["__g"], "left").filter(inside).drop("__g")


def distinct_counts(
    frame: DataFrame, keys: Sequence[str], counts: Mapping[str, tuple[str, Column | None]]
) -> DataFrame:
    """Conditional distinct counts per group: ``{output: (id column, condition or None)}``.

    Rows are reduced to one per (group, id) before the shuffle, with one flag per condition; the
    built-in form copies each row once for every different condition.
    """
    ids = list(dict.fromkeys(column for column, _ in counts.values()))
    flags = {name: F.lit(True) if test is None else F.coalesce(test, F.lit(False)) for name, (_, test) in counts.items()}
    stacked = frame.select(
        *keys,
        *[flag.alias(f"__{name}") for name, flag in flags.items()],
        F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("id")) for c in ids])).alias("__id"),
    )
    per_id = stacked.groupBy(*keys, "__id").agg(*[F.bool_or(f"__{name}").alias(f"__{name}") for name in counts])
    present = F.col("__id.id").isNotNull()
    return per_id.groupBy(*keys).agg(
        *[
            F.count_if(F.col(f"__{name}") & present & (F.col("__id.kind") == column)).alias(name)
            for name, (column, _) in counts.items()
        ]
    )


def count_columns(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null count of every other column per group. origin: pandas, groups with a null key drop out."""
    for key in keys:
        frame = frame.filter(F.col(key).isNotNull())
    return frame.groupBy(*keys).agg(*[F.count(c).alias(c) for c in frame.columns if c not in keys])


def flag_any(test: Column) -> Column:
    """'Y' if the test holds for some row of the group, else 'N'. A flag, unlike a string, aggregates by hash."""
    return F.when(F.bool_or(test), "Y").otherwise("N")


def mean(value: str) -> Column:
    """Mean as a double; for decimals it divides the exact sum, so it does not depend on row order."""
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
