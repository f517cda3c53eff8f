"""Where reports go: CSV folders, CSV with a row number, named tables, one folder per lender.

Every sink takes an ``order``. A report in one piece is sorted by range, so its files follow one another in that order;
a report split by lender is sorted within each lender's files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanops.functions.rules import blank_nulls
from loanops.session import checkpoint_folder

# A header line, and quotes inside a cell doubled, as other readers expect.
CSV = {"header": True, "escape": '"'}


def as_text(frame: DataFrame) -> DataFrame:
    """``frame`` with arrays, maps and structs as JSON text, which CSV can hold."""
    nested = [f.name for f in frame.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return frame.withColumns({n: F.to_json(F.col(f"`{n}`")) for n in nested}) if nested else frame


def _ordered(frame: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return frame.orderBy(*order) if order else frame


def write_csv(frame: DataFrame, folder: str, order: Sequence[str | Column] = ()) -> None:
    as_text(_ordered(frame, order)).write.mode("overwrite").options(**CSV).csv(folder)


def with_row_number(frame: DataFrame, order: Sequence[str | Column], name: str = "index") -> DataFrame:
    """Rows numbered from 0 in ``order``, without sorting everything in one task.

    Range-partitioned sort, then offsets from the partition sizes. Needs a checkpoint folder: numbers are
    taken from one fixed run. A hidden last sort key lets rows of equal order spread over several ranges; it
    follows content and input partition, so a retried task repeats it.
    """
    checkpoint_folder(frame.sparkSession)
    columns = [F.col(f"`{c}`") for c in frame.columns]
    hashable = [F.col(f"`{f.name}`") for f in frame.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    tie = F.xxhash64(F.spark_partition_id(), *hashable)
    ranged = frame.withColumn("__tie", tie).orderBy(*order, "__tie").drop("__tie")
    fixed = ranged.withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    # The generated id holds the partition above bit 33 and the position below.
    placed = fixed.withColumns({"__part": F.shiftright("__at", 33), "__pos": F.col("__at").bitwiseAND((1 << 33) - 1)})
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count("*").alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "__part")
    return numbered.select((F.col("__offset") + F.col("__pos")).alias(name), *columns)


def write_indexed_csv(frame: DataFrame, folder: str, order: Sequence[str | Column]) -> None:
    """CSV with a row number, in its order."""
    write_csv(with_row_number(frame, order), folder, ["index"])


def table_name(title: str) -> str:
    """Lower case with underscores; a plus sign is spelled, because published names differ by it alone."""
    return re.sub(r"\W+", "_", title.strip().lower().replace("+", " plus")).strip("_")


def table_columns(titles: Sequence[str]) -> dict[str, str]:
    """Published column names to table column names; names that would still be equal are refused."""
    names = {title: table_name(title) for title in titles}
    twice = sorted({n for n in names.values() if list(names.values()).count(n) > 1})
    if twice:
        raise ValueError(f"columns with the same table name: {twice}")
    return names


def publish(frame: DataFrame, title: str, folder: str | None = None, delivery: bool = False, order: Sequence[str | Column] = ()) -> None:
    """Replace the report named ``title``: a managed table, or a parquet folder below ``folder``.

    Columns get table names and keep their published names as comments. ``delivery``: all cells as text and nulls as empty
    text, for sheet-like consumers.
    """
    frame = _ordered(frame, order)
    frame = blank_nulls(as_text(frame)) if delivery else frame
    names = table_columns(frame.columns)
    frame = frame.select(*[F.col(f"`{c}`").alias(n, metadata={"comment": c}) for c, n in names.items()])
    writer = frame.write.mode("overwrite")
    if folder is None:
        writer.saveAsTable(table_name(title))
    else:
        writer.parquet(f"{folder}/{table_name(title)}")


def publish_all(
    reports: Mapping[str, DataFrame],
    folder: str | None = None,
    delivery: bool = False,
    orders: Mapping[str, Sequence[str | Column]] | None = None,
) -> None:
    """Every report of a run; each is its own job. ``orders``: sort order by title."""
    for title, frame in reports.items():
        publish(frame, title, folder, delivery, (orders or {}).get(title, ()))


_MANIFEST = "run long, id string, title string, place string"


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def publish_run(
    reports: Mapping[str, DataFrame],
    folder: str,
    delivery: bool = False,
    orders: Mapping[str, Sequence[str | Column]] | None = None,
) -> int:
    """Publish all reports or none: they are written beside the earlier ones, and one added file of the manifest makes them the current ones.

    Readers that go through ``read_published`` see one run's reports, never a mixture. A run that fails leaves the last one current. A report
    that a run does not have is no longer published. Returns the number of the run.
    """
    if len({table_name(title) for title in reports}) < len(reports):
        raise ValueError(f"titles with the same table name: {list(reports)}")
    first = next(iter(reports.values()))
    spark, id = first.sparkSession, uuid.uuid4().hex
    publish_all(reports, f"{folder}/runs/{id}", delivery, orders)
    newest = _manifest(spark, folder).agg(F.max("run")).first()[0]
    run = 1 if newest is None else newest + 1
    places = F.inline(F.array(*[F.struct(F.lit(t).alias("title"), F.lit(f"{folder}/runs/{id}/{table_name(t)}").alias("place")) for t in reports]))
    rows = spark.range(0, 1, 1, 1).select(F.lit(run).cast("long").alias("run"), F.lit(id).alias("id"), places)
    rows.write.mode("append").parquet(f"{folder}/manifest")
    return run


def read_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The reports of the last complete run by title."""
    manifest = _manifest(spark, folder)
    last = manifest.agg(F.max(F.struct("run", "id")).alias("last")).select("last.*").first()
    rows = manifest.filter((F.col("run") == last["run"]) & (F.col("id") == last["id"])).collect() if last["run"] else []
    return {r["title"]: spark.read.parquet(r["place"]) for r in rows}


def write_per_lender(
    frame: DataFrame,
    folder: str,
    lender: str = "lender_id",
    order: Sequence[str | Column] = (),
    rows_per_file: int = 0,
    keep_others: bool = False,
) -> None:
    """One CSV folder per lender, null lenders included, from a single pass; rows keep the lender column.

    Rows are brought together by lender first, so a lender has few files; a large one is split to files of even size, and of at most
    ``rows_per_file`` rows if that is given. ``keep_others``: replace only the folders of lenders that ``frame`` has.
    """
    copy = frame.withColumn("lender", F.col(f"`{lender}`")).hint("rebalance", F.col("lender"))
    copy = copy.sortWithinPartitions("lender", *order) if order else copy
    writer = as_text(copy).write.mode("overwrite").partitionBy("lender").options(**CSV)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.option("partitionOverwriteMode", "dynamic" if keep_others else "static").csv(folder)
