"""Language ID by Bayesian fusion of text, declared language, address suffix and host.

log posterior(l) = TEXT_WEIGHT * log P(letter trigrams | l) + log P(declared | l) + log prior(l | host, address suffix)

* Text: byte trigrams of letters (A-Z lower-cased, all other ASCII bytes count as one separator), hashed to 2^``BITS`` buckets,
  counted over all documents by declared language. Trigrams overlap, so their sum is weighted by a third.
* Declared language: counts (language by text, declared value) over all documents, smoothed.
* Prior: counts of the languages by text on the host, smoothed towards those of its address suffix, and these
  towards all documents (``KAPPA`` pseudo-documents each). Grouped aggregations; a hot host is pre-aggregated. Priors
  of up to ``BROADCAST_HOSTS`` hosts are broadcast; of more, the join has two exchanged sides, which Spark can split.
* ``und`` (no known language) gives every bucket the same probability and has the prior ``UND_PRIOR``.

A document is kept if its best language is not ``und`` and has a posterior of at least ``LEAST_POSTERIOR``.

Defined cases: a null, empty or letterless text is rejected with language ``und`` and posterior null. Null or unsupported declared
languages, null suffixes and null hosts say nothing (a null host has the prior of its suffix). With no declared documents at all
every bucket is equally likely, and documents are rejected unless the priors decide. Ties go to the language that comes first in
``languages``. Repeated rows are judged each; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkit import ASCII_LOWER, Texts, arrow_sized, chunks_of, free_name, settled

LANGUAGES = ("de", "en", "es", "fr")
UND = "und"
BITS = 14
TEXT_WEIGHT = 1 / 3
KAPPA = 20.0
UND_PRIOR = 1e-3
LEAST_POSTERIOR = 0.5
BROADCAST_HOSTS = 100_000  # priors of up to so many hosts are broadcast (at most about 20 MB), of more are joined by shuffle

LETTERS = ASCII_LOWER.copy()
LETTERS[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 0x20


def trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of a chunk, text by text, and their number for each text. A text is framed by separators."""
    sizes = np.diff(texts.offsets)
    framed = np.full(len(texts.data) + 2 * len(sizes), 0x20, np.uint8)
    begin = texts.offsets[:-1] + 2 * np.arange(len(sizes)) + 1
    place = np.repeat(begin - texts.offsets[:-1], sizes) + np.arange(len(texts.data))
    framed[place] = LETTERS[texts.data]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    centre = framed[place]
    letter = centre != 0x20
    place, owner = place[letter], owner[letter]
    wide = framed.astype(np.uint32)
    code = (wide[place - 1] << np.uint32(16)) | (wide[place] << np.uint32(8)) | wide[place + 1]
    buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return buckets.astype(np.int64), np.bincount(owner, minlength=len(sizes))


def _own(docs: DataFrame, *columns: str | None) -> list[Column]:
    return [F.lit(None).cast("string") if c is None else F.col(f"`{c}`") for c in columns]


def trigram_model(docs: DataFrame, text_column: str, declared_column: str, languages: Sequence[str]) -> np.ndarray:
    """log P(bucket | language) by row of ``languages``, and a last row for ``und``; counts over all documents."""
    arrow_sized(docs.sparkSession)
    names = list(languages)

    def count(batches):
        total = np.zeros((len(names), 1 << BITS), np.int64)
        row = {k: i for i, k in enumerate(names)}
        for batch in batches:
            label = np.array([row.get(v, -1) for v in batch.column(1).to_pylist()], np.int64)
            for texts in chunks_of(batch.column(0)):
                buckets, counts = trigrams(texts)
                own = np.repeat(label[texts.first : texts.first + len(counts)], counts)
                for i in range(len(names)):
                    total[i] += np.bincount(buckets[own == i], minlength=1 << BITS)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(total[at])], ["language", "bucket", "n"]
        )

    text, declared = _own(docs, text_column, declared_column)
    seen = docs.select(text.alias("text"), F.lower(F.trim(declared.cast("string"))).alias("declared"))
    sums = seen.mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((len(names) + 1, 1 << BITS), 0.5)
    for r in sums.collect():  # at most languages * 2^BITS rows
        counts[r["language"], r["bucket"]] += r["n"]
    return np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def text_evidence(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log likelihoods of each text (languages, then ``und``), and its number of trigrams. ``table`` has a row for each bucket."""
    sums = np.zeros((len(column), table.shape[1]))
    seen = np.zeros(len(column), np.int64)
    for texts in chunks_of(column):
        buckets, counts = trigrams(texts)
        full = np.flatnonzero(counts)
        if len(full):
            begin = (np.cumsum(counts) - counts)[full]
            sums[texts.first + full] = np.add.reduceat(table[buckets], begin, axis=0, dtype=np.float64)
        seen[texts.first : texts.first + len(counts)] = counts
    return sums * TEXT_WEIGHT, seen


def _names(best: np.ndarray, names: Sequence[str], known: np.ndarray) -> pa.Array:
    return pa.array([names[b] if k else None for b, k in zip(best, known, strict=True)], pa.string())


def languages_by_text(docs: DataFrame, model: np.ndarray, languages: Sequence[str]) -> DataFrame:
    """``docs`` (text, declared, host, suffix) with the likeliest language by text in place of the text; texts without letters go."""
    sent = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model[:-1].T))

    def run(batches):
        for batch in batches:
            sums, seen = text_evidence(batch.column(0), sent.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], _names(sums.argmax(1), languages, seen > 0)], [*batch.schema.names[1:], "by_text"])

    return docs.mapInArrow(run, "declared string, host string, suffix string, by_text string").where(F.col("by_text").isNotNull())


def declared_table(counts: dict[str, list[float]], kinds: int) -> dict[str, np.ndarray]:
    """log P(declared | language) for each declared value; for ``und`` the value is as likely as anywhere."""
    if not counts:
        return {}
    names = sorted(counts)
    table = np.array([counts[k][:kinds] for k in names]) + 0.5
    given = np.log(table / table.sum(0))
    anywhere = np.log(table.sum(1) / table.sum())
    return {k: np.append(given[i], anywhere[i]) for i, k in enumerate(names)}


def identify(docs: DataFrame, text_column: str = "text", declared_column: str = "lang", host_column: str | None = "source",
             suffix_column: str | None = None, languages: Sequence[str] = LANGUAGES, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus ``{prefix}language``, ``{prefix}posterior``, ``{prefix}text_language``, ``{prefix}kept``."""
    languages = tuple(languages)
    kinds = len(languages)
    names = (*languages, UND)
    declared, host, suffix = _own(docs, declared_column, host_column, suffix_column)
    declared = F.lower(F.trim(declared.cast("string")))
    suffix = F.coalesce(suffix.cast("string"), F.lit(""))
    model = trigram_model(docs, text_column, declared_column, languages)
    slim = docs.select(F.col(f"`{text_column}`").alias("text"), declared.alias("declared"), host.cast("string").alias("host"), suffix.alias("suffix"))
    by_host = settled(
        languages_by_text(slim, model, languages).groupBy("declared", "host", "suffix", "by_text").agg(F.count(F.lit(1)).alias("docs"))
    )  # pre-aggregated; everything below is sums of it

    def sums(*keys: str) -> DataFrame:
        cells = [F.coalesce(F.sum(F.when(F.col("by_text") == k, F.col("docs"))), F.lit(0)).cast("double") for k in languages]
        return by_host.groupBy(*keys).agg(F.array(*cells).alias("n"))

    # at most len(languages) supported declared values
    told = declared_table({r["declared"]: list(r["n"]) for r in sums("declared").where(F.col("declared").isin(*languages)).collect()}, kinds)
    overall = np.array(sums().first()["n"]) + 1.0
    overall = overall / overall.sum()

    def smoothed(counts: Column, base: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + KAPPA
        return F.zip_with(counts, base, lambda n, p: (n + F.lit(KAPPA) * p) / total)

    flat = F.array(*[F.lit(float(p)) for p in overall])
    suffixes = settled(sums("suffix").select("suffix", smoothed(F.col("n"), flat).alias("suffix_prior")))
    hosts = sums("host", "suffix").where(F.col("host").isNotNull()).join(suffixes, "suffix")
    hosts = hosts.select("host", "suffix", smoothed(F.col("n"), F.col("suffix_prior")).alias("prior"))
    key, prior = free_name(docs, "prior_key"), free_name(docs, "prior_log")
    priors = settled(
        hosts.union(suffixes.select(F.lit(None).cast("string"), "suffix", "suffix_prior")).select(
            F.concat_ws("\x01", "suffix", F.lit("h"), "host").alias(key), F.transform("prior", lambda p: F.log(p)).alias(prior)
        )
    )
    few = priors.count() <= BROADCAST_HOSTS
    joined = docs.withColumn(key, F.concat_ws("\x01", suffix, F.lit("h"), host.cast("string")))
    joined = joined.withColumn(free_name(docs, "prior_told"), declared).join(F.broadcast(priors) if few else priors, key, "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], free_name(docs, "prior_told"), prior)
    at = docs.columns.index(text_column)
    fallback = np.log(overall)
    sent = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    added = [f"{prefix}language", f"{prefix}posterior", f"{prefix}text_language", f"{prefix}kept"]

    def run(batches):
        nothing = np.zeros(kinds + 1)
        for batch in batches:
            *own, said, before = batch.columns
            text, seen = text_evidence(own[at], sent.value)
            known = seen > 0
            known_prior = np.array([fallback if p is None else p for p in before.to_pylist()]).reshape(-1, kinds)
            prior = np.hstack([known_prior + np.log1p(-UND_PRIOR), np.full((len(text), 1), np.log(UND_PRIOR))])
            total = text + prior + np.array([told.get(k, nothing) for k in said.to_pylist()]).reshape(-1, kinds + 1)
            best = total.argmax(1)
            share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            language = np.where(known, best, kinds)
            columns = [
                _names(language, names, np.ones(len(best), bool)),
                pa.array(share, mask=~known),
                _names(text[:, :kinds].argmax(1), languages, known),
                pa.array(known & (best < kinds) & (share >= LEAST_POSTERIOR)),
            ]
            yield pa.RecordBatch.from_arrays([*own, *columns], [*batch.schema.names[: len(own)], *added])

    kinds_added = (T.StringType(), T.DoubleType(), T.StringType(), T.BooleanType())
    fields = [*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(added, kinds_added, strict=True))]
    return joined.mapInArrow(run, T.StructType(fields))


def keep_known_languages(docs: DataFrame, text_column: str = "text", declared_column: str = "lang", host_column: str = "source") -> DataFrame:
    """The documents that ``identify`` keeps, with their own columns."""
    prefix = "id_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return identify(docs, text_column, declared_column, host_column, prefix=prefix).where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
