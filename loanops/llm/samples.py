"""A bounded sample of labelled documents for training, and how a trained model reaches the tasks.

``labels`` may repeat an id (its smallest label counts) and may name ids without a document. The sample is the
labelled ids of lowest seeded hash, at most ``per_class`` of each label, so it is the same in every run; because
its size is bounded, it may be broadcast, and the texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_ids(labels: DataFrame, id_column: str, label_column: str, keep) -> DataFrame:
    """(id, label): each labelled id for which ``keep(id)`` holds."""
    return (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & keep(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )


def labelled_sample(labels: DataFrame, id_column: str, label_column: str, keep, per_class: int, seed: int) -> DataFrame:
    """(id, label, turn): at most ``per_class`` ids of each label for which ``keep(id)`` holds, in seeded order."""
    one = labelled_ids(labels, id_column, label_column, keep).withColumn("turn", F.xxhash64(F.lit(seed), "id"))
    chosen = [one.where(F.col("label") == k).orderBy("turn", "id").limit(per_class) for k in (0, 1)]
    return chosen[0].union(chosen[1])


def label_shares(labels: DataFrame, id_column: str, label_column: str, keep) -> dict[int, int]:
    """How many ids have each label, over all labelled ids for which ``keep(id)`` holds."""
    one = labelled_ids(labels, id_column, label_column, keep)
    return {row["label"]: row["n"] for row in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def sampled_texts(docs: DataFrame, id_column: str, text_column: str, sample: DataFrame, *more: str) -> DataFrame:
    """(id, label, turn, text, more...): the documents of the sample."""
    own = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"), *(F.col(f"`{m}`") for m in more)
    )
    return own.join(F.broadcast(sample), "id")


def trained(examples: DataFrame, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """``fit`` run in one task over the examples of a bounded sample; its arrays, read back on the driver."""

    def run(batches):
        table = pa.Table.from_batches(list(batches), schema=wanted)
        model = fit(table)
        yield pa.RecordBatch.from_pydict(
            {
                "name": list(model),
                "kind": [v.dtype.str for v in model.values()],
                "shape": [list(v.shape) for v in model.values()],
                "data": [np.ascontiguousarray(v).tobytes() for v in model.values()],
            },
            schema=pa.schema([("name", pa.string()), ("kind", pa.string()), ("shape", pa.list_(pa.int64())), ("data", pa.binary())]),
        )

    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(examples.schema)
    single = examples.repartition(1)
    rows = single.mapInArrow(run, "name string, kind string, shape array<bigint>, data binary").collect()
    return {r["name"]: np.frombuffer(r["data"], np.dtype(r["kind"])).reshape(r["shape"]).copy() for r in rows}
