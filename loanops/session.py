"""Session settings that the plans count on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings; safe to apply to a session that somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Both sides of a join on (group, value) are exchanged, so a hot partition can be split.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # The marks of a spread join are one subquery that both of its sides read.
    "spark.sql.execution.reuseSubquery": "true",
    # Split a hot join partition even where that costs one more exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings of the session's start; a cluster's submit command should give them too.
START_CONF = {
    # Call sites of every column function, for error messages only: recording them takes most of the time in which a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A report of many stages has more generated classes than the default 100; without room each run compiles them again.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loanops")
        .config(map=START_CONF)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the one the session names; in local mode else a fresh temporary one.

    A cluster has to name one that driver and executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="loanops-checkpoint-")
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(folder)
    return folder
