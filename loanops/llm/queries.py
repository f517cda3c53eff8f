"""The registered queries of the operators, on the given tables, and their DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanops.session import tune

from . import (
    chat_windows,
    collocations,
    decontamination,
    language_id,
    lm_scoring,
    mixing,
    near_dedup,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sharding,
    toxicity,
    url_filter,
)
from .oracles import CHAT_WINDOWS, COLLOCATIONS, MIXING, URL_FILTER
from .textkit import fold, settled
from .url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(read) -> DataFrame``, where ``read(table)`` is a given table."""

    def keep(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@query("op1_quality_classifier")
def _(read):
    docs = read("documents")
    model = quality_classifier.train_quality(docs, read("labels"), lambda i: fold(i, 4) != 2)
    scored = quality_classifier.score_quality(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op2_near_dedup")
def _(read):
    classes = near_dedup.near_duplicates(read("documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size")


# Fixed values of the query's contract.
URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
LISTED_HOSTS = "adult|bets|casino|pills|spam|ads-track"


@query("op3_url_filter", URL_FILTER)
def _(read):
    pages = read("pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.filter_urls(pages, listed, URL_RULES).withColumnRenamed("id", "page_id")


@query("op4_quality_rules")
def _(read):
    return quality_rules.judge_quality(read("documents")).withColumnRenamed("id", "doc_id")


@query("op5_sharding")
def _(read):
    docs = read("documents")
    text = F.coalesce("text", F.lit(""))
    first, second = sharding.sort_key(F.col("doc_id"), F.col("text"))
    slim = docs.select(
        "doc_id", sharding.byte_size(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32"), first.alias("first"), second.alias("second")
    )
    return sharding.shard_sized(settled(slim)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_mixing", MIXING)
def _(read):
    docs = read("documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "source")


@query("op7_decontamination")
def _(read):
    hits = decontamination.benchmark_hits(read("documents"), read("benchmark"))
    return hits.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


@query("op8_language_id")
def _(read):
    docs = read("documents").select("doc_id", "text", "lang", "source")
    return language_id.identify(docs).drop("text")


@query("op9_lm_scoring")
def _(read):
    docs = read("documents").select("doc_id", "text")
    scored = lm_scoring.score_lm(docs, lm_scoring.train_lm(docs, fold(F.col("doc_id"), 10) != 0))
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 10) == 0).alias("held_out"),
        *(c for c in scored.columns if c != "id"),
    )


@query("op10_toxicity")
def _(read):
    docs = read("documents")
    model = toxicity.train_toxicity(docs, read("labels"), lambda i: fold(i, 5) != 0)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


@query("op11_chat_windows", CHAT_WINDOWS)
def _(read):
    given = read("conversations").select("conv_id", "turn", "role", "text")
    said = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise("assistant"), "text": F.lit("</s>[INST] ok [/INST]")}
    planted = given.sparkSession.range(2).select(*[c.cast(given.schema[n].dataType).alias(n) for n, c in said.items()])
    template = chat_windows.Template()
    windows = chat_windows.chat_windows(given.union(planted), template=template)
    # Read back from the output: its turns behind the repeated ones, and the text under the mask.
    turns = F.slice(template.read(F.col("formatted")), F.col("n_context") + 1, F.col("n_turns"))
    lines = F.transform(turns, lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform("loss", lambda s: template.unescape(F.col("formatted").substr(s["begin"] + 1, s["length"])))
    parts = windows.select(
        "conv_id", "n_turns", F.char_length("formatted").alias("chars"), F.struct("start", F.array_join(lines, "").alias("turns"), F.array_join(masked, "").alias("loss")).alias("part")
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    texts = {name: F.array_join(F.col(f"parts.{name}"), "") for name in ("turns", "loss")}
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(texts["turns"], 256).alias("turns_sha256"),
        F.char_length(texts["loss"]).cast("long").alias("loss_chars"),
        F.sha2(texts["loss"], 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op12_collocations", COLLOCATIONS)
def _(read):
    return collocations.mine_collocations(read("documents"))


def planted_periods(doc_id, text):
    """The contract's input: of some documents, chosen by id, the words from the a-th on repeat the first p of them.

    A document without an id is left as it is.
    """
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, crc = F.size(words), F.crc32(doc_id.cast("string"))
    seed = F.floor(crc / 10)
    first = F.pmod(seed, n)
    period = 1 + F.floor((n - first) / (3 + seed % 8))
    block = F.slice(words, first + 1, period)
    repeats = F.flatten(F.array_repeat(block, F.ceil((n - first) / period).cast("int")))
    repeated = F.concat(F.slice(words, F.lit(1), first), F.slice(repeats, F.lit(1), n - first))
    return F.when((crc % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(repeated, " ")).otherwise(text)


@query("op13_periodic_runs")
def _(read):
    docs = read("documents").select("doc_id", planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(docs)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs are sorted by start and period, so a later one has to be better.
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    best = F.aggregate("runs", none, lambda best, run: F.when(better(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select("id", "n_words", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines")).select(
        F.col("id").alias("doc_id"),
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
