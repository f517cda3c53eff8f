"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of the table rows of its hash and of the hashes of its first 4 to 7 bytes (words are lower-cased
in A-Z and end at ASCII punctuation). Filters of widths 1, 2 and 3 slide over the words of the whole text; each
filter's largest rectified value goes to a logistic output. Training takes a bounded sample (``per_class`` documents of
each label, without those of over ``MOST_WORDS`` words), and the bias is moved from the sample's share of labels to the share over all labels that may be
learned from. A fifth of those labels (by hash) never enters the sample. Each language's threshold has the best F1 over all
documents that may be learned from and are not in the sample, scored in a pass of their own and counted by language, label and score; documents of a
label weigh as many as the label has in that language, those of the sample included. Language is only used there, never for a score.

Defined cases: a null, empty or wordless text has no positive filter value and scores by the bias alone. Without labels of both
kinds every score is the share of label 1. A language without documents of both kinds outside the sample has threshold 0.5; if the other four
fifths lack a label, the sample is drawn from all.
Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_classifier import TOKEN_BYTES
from .samples import label_shares, labelled_ids, labelled_sample, sampled_texts, trained
from .textkit import ASCII_LOWER, Texts, arrow_sized, chunks_of, span_hashes, spans

BITS = 17
DEPTH = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6, 7)
PER_CLASS = 3000
MOST_WORDS = 20_000
EPOCHS = 12
BATCH = 8
RATE = 0.1
PRIOR_HITS = 20
HELD = 5  # one part of so many never enters the sample
STEPS = 256  # of a score's logit are counted as one

PLAIN_WORDS = np.where(TOKEN_BYTES == 1, 1, 0).astype(np.uint8)
PAD = max(WIDTHS) - 1


def word_rows(texts: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word, (words, 1 + prefixes), and the number of words of each text."""
    lowered = texts._replace(data=ASCII_LOWER[texts.data])
    words = spans(lowered, PLAIN_WORDS)
    rows = np.empty((len(words.start), 1 + len(PREFIXES)), np.int64)
    for k, size in enumerate((None, *PREFIXES)):
        end = words.end if size is None else np.minimum(words.end, words.start + size)
        hashes = span_hashes(lowered.data, words.start, end) * np.uint64(2 * k + 1)
        rows[:, k] = hashes >> np.uint64(64 - bits)
    return rows, words.counts


def embedded(table: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings with ``PAD`` rows of zeros behind each text, and where each text begins in them."""
    total = table[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        total += table[rows[:, k]]
    starts = np.cumsum(counts + PAD) - (counts + PAD)
    out = np.zeros((len(rows) + PAD * len(counts), table.shape[1]), np.float32)
    out[np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * PAD, counts)] = total
    return out, starts


def convolved(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, filters: list[np.ndarray], biases: np.ndarray) -> list[np.ndarray]:
    """For each width, rectified filter values at each word; zero at the pads."""
    pads = (np.repeat(starts + counts, PAD) + np.tile(np.arange(PAD), len(counts))) if len(counts) else np.zeros(0, np.int64)
    out = []
    for w, weights, bias in zip(WIDTHS, filters, biases, strict=True):
        y = x @ weights[0]
        for k in range(1, w):
            y[: len(x) - k] += x[k:] @ weights[k]
        y += bias
        np.maximum(y, 0, out=y)
        y[pads] = 0
        out.append(y)
    return out


def pooled(values: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.maximum.reduceat(y, starts, axis=0) for y in values], axis=1)


def scores_of(model: dict[str, np.ndarray], texts: Texts) -> np.ndarray:
    """Logit of each text of a chunk."""
    rows, counts = word_rows(texts)
    x, starts = embedded(model["table"], rows, counts)
    filters = [model[f"filters{w}"] for w in WIDTHS]
    return pooled(convolved(x, starts, counts, filters, model["biases"]), starts) @ model["output"] + model["bias"][0]


def train_cnn(examples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Adagrad on minibatches; through max pooling only the words at each filter's largest value learn."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.02, (1 << bits, DEPTH)).astype(np.float32)
    filters = [draw.normal(0, 0.4, (w, DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases = np.full((len(WIDTHS), FILTERS), 0.05, np.float32)
    output = draw.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
    bias = np.zeros(1, np.float32)
    seen = {id(v): np.full(v.shape, 1e-2, np.float32) for v in (table, *filters, biases, output, bias)}

    def step(value, gradient, at=...):
        past = seen[id(value)]
        past[at] += gradient * gradient
        value[at] -= RATE * gradient / np.sqrt(past[at])

    for _ in range(epochs):
        order = draw.permutation(len(examples))
        for begin in range(0, len(order), BATCH):
            own = order[begin : begin + BATCH]
            rows = np.concatenate([examples[i] for i in own])
            counts = np.array([len(examples[i]) for i in own])
            x, starts = embedded(table, rows, counts)
            values = convolved(x, starts, counts, filters, biases)
            best = [np.stack([y[s : s + n + PAD].argmax(0) + s for s, n in zip(starts, counts, strict=True)]) for y in values]
            pool = np.concatenate([np.take_along_axis(y, b, 0) for y, b in zip(values, best, strict=True)], axis=1)
            logits = np.clip(pool @ output + bias[0], -30, 30)
            error = ((1 / (1 + np.exp(-logits)) - labels[own]) / len(own)).astype(np.float32)
            back = error[:, None] * output * (pool > 0)
            g_x, touched = np.zeros_like(x), np.zeros(len(x), bool)
            g_biases = np.zeros_like(biases)
            for j, (w, b) in enumerate(zip(WIDTHS, best, strict=True)):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                g_biases[j] = g.sum(0)
                g_filter = np.zeros_like(filters[j])
                for k in range(w):
                    at = np.minimum(b + k, len(x) - 1)
                    g_filter[k] = np.einsum("bf,bfd->df", g, x[at])
                    np.add.at(g_x, at.ravel(), (g[:, :, None] * filters[j][k].T[None]).reshape(-1, DEPTH))
                    touched[at.ravel()] = True
                step(filters[j], g_filter + 1e-5 * filters[j])
            step(output, error @ pool + 1e-4 * output)
            step(bias, error.sum(keepdims=True))
            step(biases, g_biases)
            place = np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * PAD, counts)
            learn = touched[place]
            hit, inverse = np.unique(rows[learn].ravel(), return_inverse=True)
            if len(hit):
                summed = np.zeros((len(hit), DEPTH), np.float32)
                np.add.at(summed, inverse, np.repeat(g_x[place[learn]], rows.shape[1], axis=0))
                step(table, summed, hit)
    return {"table": table, **{f"filters{w}": f for w, f in zip(WIDTHS, filters, strict=True)}, "biases": biases, "output": output, "bias": bias}


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, toxic: float | None = None) -> float:
    """The threshold of largest F1 (midway between neighbours; of equal ones the one nearest 0.5), drawn towards 0.5 as if by ``PRIOR_HITS`` toxic texts.

    A score counts ``weights`` times; ``toxic`` is how many toxic texts were seen, if not the sum of their weights.
    """
    if not labels.any() or labels.all():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    weights = np.ones(len(scores)) if weights is None else weights
    ranked, hits = scores[order], np.cumsum((weights * labels)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + hits[-1])
    edges = np.append((ranked[:-1] + ranked[1:]) / 2, ranked[-1])
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    hits = float(hits[-1] if toxic is None else toxic)
    return float((hits * edges[top[np.argmin(np.abs(edges[top] - 0.5))]] + PRIOR_HITS * 0.5) / (hits + PRIOR_HITS))


def _threshold(counts: pa.Table) -> pa.Table:
    """The threshold of one language from its (language, label, step, outside, every) counts."""
    labels, outside, every = (counts[k].to_numpy().astype(np.float64) for k in ("label", "outside", "every"))
    scores = 1 / (1 + np.exp(-(counts["step"].to_numpy() + 0.5) / STEPS))
    weights, seen = np.zeros(len(labels)), outside > 0
    for label in (0, 1):
        own = labels == label
        weights[own] = outside[own] * (every[own].sum() / max(outside[own].sum(), 1))
    limit = best_threshold(scores[seen], labels[seen], weights[seen], (outside * labels).sum())
    return pa.table({"language": counts["language"][:1], "threshold": pa.array([limit])})


def calibrated(scored: DataFrame, marks: DataFrame) -> dict[str, np.ndarray]:
    """Thresholds of the languages: ``scored`` (id, language, score), ``marks`` (id, label, fitted)."""
    step = F.floor(F.log(F.col("score") / (1 - F.col("score"))) * STEPS)
    counts = (
        scored.select("id", F.coalesce("language", F.lit("")).alias("language"), step.alias("step"))
        .join(marks, "id")
        .groupBy("language", "label", "step")
        .agg(F.sum((~F.col("fitted")).cast("long")).alias("outside"), F.count(F.lit(1)).alias("every"))
    )
    rows = counts.groupBy("language").applyInArrow(_threshold, "language string, threshold double").orderBy("language").collect()
    return {
        "languages": np.array([r["language"].encode() for r in rows], dtype=object),
        "thresholds": np.array([r["threshold"] for r in rows], np.float64),
    }


def _fit(shift: float):
    def fit(table: pa.Table) -> dict[str, np.ndarray]:
        table = table.take(pa.array(np.lexsort([table["id"].to_numpy(), table["turn"].to_numpy()])))
        labels, examples = table["label"].to_numpy(), []
        for texts in chunks_of(table["text"]):
            rows, counts = word_rows(texts)
            examples += np.split(rows, np.cumsum(counts)[:-1])
        fits = [i for i in range(len(examples)) if len(examples[i]) <= MOST_WORDS]
        model = train_cnn([examples[i] for i in fits], labels[fits])
        model["bias"] = model["bias"] + np.float32(shift)
        return model

    return fit


def train_toxicity(docs: DataFrame, labels: DataFrame, keep, id_column="doc_id", text_column="text", label_column="toxic",
                   language_column="lang", per_class: int = PER_CLASS, seed: int = 2) -> dict[str, np.ndarray] | float:
    """The trained arrays, or the share of label 1 where only one kind of label exists."""
    shares = label_shares(labels, id_column, label_column, keep)
    zeros, ones = shares.get(0, 0), shares.get(1, 0)
    if not zeros or not ones:
        return (ones + 0.5) / (zeros + ones + 1)

    def fits(i):
        return keep(i) & (F.pmod(F.xxhash64(F.lit(seed + 1), i), F.lit(HELD)) != HELD - 1)

    part = label_shares(labels, id_column, label_column, fits)
    if len(part) < 2:
        fits, part = keep, shares
    shift = math.log(ones / zeros) - math.log(min(part[1], per_class) / min(part[0], per_class))
    sample = labelled_sample(labels, id_column, label_column, fits, per_class, seed)
    model = trained(sampled_texts(docs, id_column, text_column, sample), _fit(shift))
    fitted = F.broadcast(sample.select("id", F.lit(True).alias("fitted")))
    marks = labelled_ids(labels, id_column, label_column, keep).join(fitted, "id", "left").withColumn("fitted", F.coalesce("fitted", F.lit(False)))
    own = docs.where(F.col(f"`{id_column}`").isNotNull() & keep(F.col(f"`{id_column}`")))
    return model | calibrated(score_toxicity(own, model, id_column, text_column, language_column), marks)


def score_toxicity(docs: DataFrame, model, id_column="doc_id", text_column="text", language_column="lang") -> DataFrame:
    """(id, language, score, threshold, flagged): one row for each document; flagged by its language's threshold."""
    arrow_sized(docs.sparkSession)
    own = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{language_column}`").cast("string").alias("language"), F.col(f"`{text_column}`").alias("text")
    )
    if isinstance(model, float):
        return own.select("id", "language", F.lit(model).alias("score"), F.lit(0.5).alias("threshold"), F.lit(model >= 0.5).alias("flagged"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        levels = {k.decode(): float(v) for k, v in zip(model.get("languages", ()), model.get("thresholds", ()), strict=True)}
        for batch in batches:
            logits = [scores_of(model, texts) for texts in chunks_of(batch.column(2))]
            scores = 1 / (1 + np.exp(-np.clip(np.concatenate(logits).astype(np.float64), -30, 30))) if logits else np.zeros(0)
            limits = np.array([levels.get(k or "", 0.5) for k in batch.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array(limits), pa.array(scores >= limits)],
                ["id", "language", "score", "threshold", "flagged"],
            )

    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, language string, score double, threshold double, flagged boolean")
