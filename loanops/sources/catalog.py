"""Where tables come from: a parquet folder, the session catalog, or a relational database."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables(Mapping[str, DataFrame]):
    """Name to DataFrame; a table is opened when it is first asked for, and nothing is read before an action."""

    def __init__(self, names: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(names)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def __or__(self, other: Mapping[str, DataFrame]) -> Tables:
        """Both sets of tables in one catalog: tables of separate databases join like any others."""
        mine = {name: (lambda name=name: self[name]) for name in self}
        theirs = {name: (lambda name=name: other[name]) for name in other}
        return Tables(mine | theirs)


def from_frames(frames: Mapping[str, DataFrame]) -> Tables:
    return Tables({name: (lambda frame=frame: frame) for name, frame in frames.items()})


def from_parquet(spark: SparkSession, folder: str, names: list[str], suffix: str = ".parquet") -> Tables:
    return Tables({n: (lambda n=n: spark.read.parquet(f"{folder}/{n}{suffix}")) for n in names})


def from_catalog(spark: SparkSession, names: list[str], database: str | None = None) -> Tables:
    prefix = f"{database}." if database else ""
    return Tables({n: (lambda n=n: spark.table(prefix + n)) for n in names})


def from_jdbc(
    spark: SparkSession,
    url: str,
    names: list[str],
    properties: Mapping[str, str],
    split: Mapping[str, tuple[str, str, str, int]] | None = None,
) -> Tables:
    """Tables of a relational database, kept as zoneless timestamps.

    ``split``: per table, (column, lower, upper, partitions) for a parallel read; filters are pushed to the
    database. Credentials come in ``properties``; none are kept here.
    """

    def reader(name: str) -> DataFrame:
        source = spark.read.format("jdbc").options(**properties)
        source = source.option("url", url).option("dbtable", name).option("preferTimestampNTZ", "true")
        if split and name in split:
            column, lower, upper, parts = split[name]
            source = source.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(parts)
            )
        return source.load()

    return Tables({n: (lambda n=n: reader(n)) for n in names})
