from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanops.llm import quality_classifier, toxicity
from loanops.llm.textkit import fold

from .conftest import documents, prose

ALL = lambda i: F.lit(True)


def cases(kind: str, number: int = 240):
    rows, labels = [], []
    for i in range(number):
        text, bad = prose(i, 60), i % 3 == 0
        if bad and kind == "quality":
            text = text.replace(" ", "&&& ", 40)
        if bad and kind == "toxic":
            words = text.split()
            words[random.Random(i).randrange(60)] = random.Random(i).choice(["Stupidox,", "vilerak"])
            text = " ".join(words)
        rows.append((i, text, "en" if i % 2 else "de", "s"))
        labels.append((i, 0 if bad else 1, int(bad)))
    return rows, labels


def test_quality_learns_and_generalises(spark):
    rows, labels = cases("quality")
    docs, marks = documents(spark, rows), spark.createDataFrame(labels + labels[:5], "doc_id long, quality int, toxic int")
    model = quality_classifier.train_quality(docs, marks, lambda i: fold(i, 4) != 2)
    scores = quality_classifier.score_quality(docs, model).join(marks.distinct(), F.col("id") == F.col("doc_id")).where(fold(F.col("id"), 4) == 2).collect()
    assert len(scores) > 40
    assert all((r["score"] >= 0.7) == bool(r["quality"]) for r in scores)
    again = quality_classifier.train_quality(docs.repartition(5), marks, lambda i: fold(i, 4) != 2)
    assert np.array_equal(model[0], again[0]) and model[1] == again[1]


def test_quality_score_is_one_sparse_dot_product():
    draw = np.random.default_rng(1)
    weights = draw.normal(size=1 << quality_classifier.BITS).astype(np.float32)
    part = next(quality_classifier.chunks_of(pa.array(["a b, a b"])))
    buckets, numbers = quality_classifier.feature_buckets(part)
    assert numbers.tolist() == [9]  # five tokens and four pairs
    own, times = np.unique(buckets, return_counts=True)
    assert (times * weights[own]).sum() == pytest.approx(weights[buckets].sum(), rel=1e-5)


def test_quality_defined_cases(spark, tricky, nothing):
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (99, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train_quality(tricky, marks, ALL)
    rows = quality_classifier.score_quality(tricky, model).collect()
    assert len(rows) == tricky.count() and all(0 < r["score"] < 1 for r in rows)
    assert len({r["score"] for r in rows if r["id"] in (4, 5, 6)}) == 1
    assert quality_classifier.score_quality(nothing, model).count() == 0
    none = quality_classifier.train_quality(nothing, marks.limit(0), ALL)
    assert {round(r["score"], 6) for r in quality_classifier.score_quality(tricky, none).collect()} == {0.5}


def test_toxicity_learns_words_and_thresholds(spark):
    rows, labels = cases("toxic", 360)
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train_toxicity(docs, marks, lambda i: fold(i, 5) != 0)
    assert set(model["languages"]) == {b"de", b"en"} and (0 < model["thresholds"]).all() and (model["thresholds"] < 1).all()
    scored = toxicity.score_toxicity(docs, model).join(marks, F.col("id") == F.col("doc_id")).where(fold(F.col("id"), 5) == 0).collect()
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in scored]
    assert len(right) > 40 and sum(right) / len(right) > 0.95


def test_convolution_by_hand():
    draw = np.random.default_rng(2)
    rows = [draw.integers(0, 50, (n, 5)) for n in (4, 0, 1)]
    table = draw.normal(size=(50, toxicity.DEPTH)).astype(np.float32)
    filters = [draw.normal(size=(w, toxicity.DEPTH, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    biases = draw.normal(size=(len(toxicity.WIDTHS), toxicity.FILTERS)).astype(np.float32)
    counts = np.array([4, 0, 1])
    x, starts = toxicity.embedded(table, np.concatenate(rows), counts)
    pool = toxicity.pooled(toxicity.convolved(x, starts, counts, filters, biases), starts)
    for own, got in zip(rows, pool):
        e = np.vstack([table[own].sum(1) if len(own) else np.zeros((0, toxicity.DEPTH)), np.zeros((2, toxicity.DEPTH))])
        want = [
            max([0.0] + [sum(e[i + k] @ filters[j][k][:, f] for k in range(w)) + biases[j][f] for i in range(len(own))])
            for j, w in enumerate(toxicity.WIDTHS)
            for f in range(toxicity.FILTERS)
        ]
        assert np.allclose(got, want, atol=1e-4)


def test_threshold_is_the_best_f1_drawn_to_the_middle():
    assert toxicity.best_threshold(np.array([0.1, 0.9]), np.array([0, 0])) == 0.5
    scores, labels = np.array([0.9, 0.8, 0.2, 0.1] * 50), np.array([1, 1, 0, 0] * 50)
    assert 0.45 < toxicity.best_threshold(scores, labels) < 0.55


def test_thresholds_count_all_labels_outside_the_fit(spark):
    # a strong word in half of the toxic texts only; a weak one in the others and in 30 % of the nine times as many clean texts
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 10 == 0
        word = ("stupidox" if i % 20 == 0 else "vilerak") if toxic else "vilerak" if i % 10 < 4 else "calm"
        rows.append((i, f"{prose(i, 8)} {word}", "en", "s"))
        labels.append((i, 1, int(toxic)))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train_toxicity(docs, marks, ALL, per_class=200)
    scored = toxicity.score_toxicity(docs, model).join(marks, F.col("id") == F.col("doc_id")).collect()
    hits = sum(r["flagged"] and r["toxic"] == 1 for r in scored)
    false = sum(r["flagged"] and r["toxic"] == 0 for r in scored)
    # flagging the weak word too: F1 0.42 over all, but 0.87 where the clean texts are thinned to the toxic ones' number
    assert 2 * hits / (hits + false + 300) > 0.6
    # thinned labels of one step count by their language's totals
    counts = pa.table({"language": ["en"] * 3, "label": [1, 1, 0], "step": [500, -200, -200], "outside": [10, 10, 20], "every": [100, 100, 2000]})
    assert toxicity._threshold(counts)["threshold"][0].as_py() > 0.5


def test_toxicity_defined_cases(spark, tricky, nothing):
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (8, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train_toxicity(tricky, marks, ALL)
    rows = toxicity.score_toxicity(tricky, model).collect()
    assert len(rows) == tricky.count() and all(0 < r["score"] < 1 for r in rows)
    assert len({r["score"] for r in rows if r["id"] in (4, 5, 6)}) == 1
    assert toxicity.score_toxicity(nothing, model).count() == 0
    assert {r["score"] for r in toxicity.score_toxicity(tricky, toxicity.train_toxicity(tricky, marks.limit(0), ALL)).collect()} == {0.5}
