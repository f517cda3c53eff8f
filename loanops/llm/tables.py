"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from loanops.session import checkpoint_folder


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and written as compressed parquet; what is read back has no lineage."""
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
