"""A corpus pipeline: language ID, near-dedup, decontamination, mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The first three drop documents; mixing returns the mix,
up to two passes over a document with its text cut down to the words taken (``n_chars`` follows the text); sharding adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanops.llm.decontamination import drop_contaminated
from loanops.llm.language_id import keep_known_languages
from loanops.llm.mixing import mix_sources, mixed_texts
from loanops.llm.near_dedup import drop_near_duplicates
from loanops.llm.sharding import shard_documents
from loanops.llm.textkit import settled
from loanops.session import tune


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return keep_known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    taken = mixed_texts(mix_sources(docs))
    return taken.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else taken


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return shard_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Trained likelihoods, sketches and seeded hashes are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settled(docs)
    return docs
