"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Tokens are runs of word bytes and runs of ASCII punctuation. Features are hashed tokens and hashed pairs of
neighbours; a pair that repeats one of the two tokens before its second is one feature of its own, whatever the word. A document's value for a feature is
``SCALE`` times the feature's share of all its features, so length does not matter, and its score is the sigmoid of one sparse dot
product plus a bias. Training sees a bounded sample (``per_class`` documents of each label), and the bias is moved from
the sample's share of labels to the share over all labels that may be learned from.

Defined cases: a null, empty or wordless text scores sigmoid(bias). Without labels of both kinds every score is the share
of label 1 (0.5 without any label). Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import label_shares, labelled_sample, sampled_texts, trained
from .textkit import WORD_BYTES, Texts, arrow_sized, chunks_of, mix, owners, span_hashes, spans, sums_by

BITS = 18
SCALE = 30.0
PER_CLASS = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5

TOKEN_BYTES = WORD_BYTES.copy()
for _first, _last in ((33, 48), (58, 65), (91, 97), (123, 127)):
    TOKEN_BYTES[_first:_last] = 2


def feature_buckets(texts: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each feature, text by text, and the number of features of each text."""
    runs = spans(texts, TOKEN_BYTES)
    hashes = span_hashes(texts.data, runs.start, runs.end)
    counts = runs.counts
    if not len(hashes):
        return np.zeros(0, np.int64), counts
    owner = owners(counts)
    pair = mix(hashes[:-1] * np.uint64(3) + mix(hashes[1:]))
    again = hashes[:-1] == hashes[1:]
    again[1:] |= hashes[:-2] == hashes[2:]
    pair[again] = np.uint64(0xABCDEF1234567 << 8)
    inside = owner[:-1] == owner[1:]
    # each token, then the pair it begins; a text's last token begins none
    slots = np.empty(2 * len(hashes), np.uint64)
    slots[::2] = hashes
    slots[1:-1:2] = pair
    real = np.ones(2 * len(hashes), bool)
    real[1:-1:2] = inside
    real[-1] = False
    numbers = np.where(counts > 0, 2 * counts - 1, 0)
    return (slots[real] >> np.uint64(64 - bits)).astype(np.int64), numbers


def train_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias by per-coordinate FTRL-proximal over (buckets, values, label), in the given order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at):
        zs = z[at]
        bound = np.where(at == 1 << bits, 0.0, L1)
        shrunk = np.sign(zs) * bound - zs
        return np.where(np.abs(zs) <= bound, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for buckets, values, label in examples:
            at, x = np.append(buckets, 1 << bits), np.append(values, 1.0)
            w = weights(at)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ x)))))
            g = (p - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    final = weights(np.arange((1 << bits) + 1))
    return final[:-1].astype(np.float32), float(final[-1])


def _fit(table: pa.Table) -> dict[str, np.ndarray]:
    order = np.lexsort([table["id"].to_numpy(), table["turn"].to_numpy()])
    table = table.take(pa.array(order))
    labels, examples = table["label"].to_numpy(), []
    for texts in chunks_of(table["text"]):
        buckets, numbers = feature_buckets(texts)
        ends = np.cumsum(numbers)
        for k in range(len(numbers)):
            own, times = np.unique(buckets[ends[k] - numbers[k] : ends[k]], return_counts=True)
            examples.append((own, times * (SCALE / max(1, numbers[k])), int(labels[texts.first + k])))
    weights, bias = train_ftrl(examples)
    return {"weights": weights, "bias": np.array([bias])}


def train_quality(docs: DataFrame, labels: DataFrame, keep, id_column="doc_id", text_column="text", label_column="quality",
                  per_class: int = PER_CLASS, seed: int = 1) -> tuple[np.ndarray, float]:
    """(weights, bias), learned only from ids for which ``keep(id)`` holds."""
    shares = label_shares(labels, id_column, label_column, keep)
    zeros, ones = shares.get(0, 0), shares.get(1, 0)
    if not zeros or not ones:
        share = (ones + 0.5) / (zeros + ones + 1)
        return np.zeros(1 << BITS, np.float32), math.log(share / (1 - share))
    sample = labelled_sample(labels, id_column, label_column, keep, per_class, seed)
    model = trained(sampled_texts(docs, id_column, text_column, sample), _fit)
    moved = math.log(ones / zeros) - math.log(min(ones, per_class) / min(zeros, per_class))
    return model["weights"], float(model["bias"][0]) + moved


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], id_column="doc_id", text_column="text") -> DataFrame:
    """(id, score): one row for each document."""
    arrow_sized(docs.sparkSession)
    sent, bias = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]

    def run(batches):
        weights = sent.value
        for batch in batches:
            scores = np.full(batch.num_rows, bias)
            for texts in chunks_of(batch.column(1)):
                buckets, numbers = feature_buckets(texts)
                dots = sums_by(numbers, weights[buckets].astype(np.float64))
                scores[texts.first : texts.first + len(numbers)] += dots * (SCALE / np.maximum(numbers, 1))
            scores = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["id", "score"])

    own = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, score double")
