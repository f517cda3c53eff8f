from __future__ import annotations

import heapq
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loanops.llm import mixing

from .conftest import documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def facts(mixed, *more):
    """The operator's struct is the last column, whatever its name."""
    return mixed.select(*more, f"{mixed.columns[-1]}.*")


def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, open_ = Fraction(3, 2) * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = Fraction(2 * sizes[s])
            left -= 2 * sizes[s]
        open_ -= full
    return {s: float(t) for s, t in target.items()}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 50, 1000, 9000]) for s in ["a", "B", "é", "z", "", None, "k"][: 3 + seed]}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = targets_by_hand(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_the_highest_quotients(spark, seed):
    draw = random.Random(seed)
    target = [draw.choice([0, 1, 1, 7, 20, 500, 90_000]) * draw.randint(1, 9) for _ in range(12)]
    target[0] = 5
    for seats in (0, 1, 7, 100, 1234):
        frame = spark.createDataFrame(list(enumerate(map(float, target))), "rank int, target double")
        got = {r["rank"]: r["quota"] for r in mixing.apportion(frame, F.lit(seats)).collect()}
        heap, want = [(-float(t), i, 0) for i, t in enumerate(target) if t], [0] * len(target)
        heapq.heapify(heap)
        for _ in range(seats):
            _, i, n = heapq.heappop(heap)
            want[i] += 1
            heapq.heappush(heap, (-target[i] / (2 * n + 3), i, n + 1))
        assert got == dict(enumerate(want)), seats


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    rows = [(i, prose(i, draw.randint(0, 400)), "en", draw.choice("aaabcde") if i % 50 else None) for i in range(600)]
    return documents(spark, rows), rows


def test_taken_words_come_near_the_targets(corpus):
    docs, rows = corpus
    mixed = facts(mixing.mix_sources(docs), "doc_id", "source").collect()
    sizes = {}
    for i, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = targets_by_hand(sizes)
    assert len(mixed) == len(rows)
    for source, target in want.items():
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - target) <= 2 * own[0]["block"] + 1
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(sizes[source], round(target, 6))}
        assert own[0]["ends"] == sorted(own[0]["ends"]) and own[0]["ends"][-1] == own[0]["quota"]
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    assert {r["doc_id"]: r["size"] for r in mixed} == {i: len(WORD.findall(t)) for i, t, _, _ in rows}


def test_reruns_agree(corpus):
    docs, _ = corpus
    one, two = (
        {(r["doc_id"], r["taken"]) for r in facts(mixing.mix_sources(f), "doc_id").collect()} for f in (docs, docs.repartition(7))
    )
    assert one == two


def test_texts_have_the_taken_words(corpus):
    docs, rows = corpus
    mixed = mixing.mix_sources(docs)
    taken = {r["doc_id"]: r["taken"] for r in facts(mixed, "doc_id").collect()}
    texts = mixing.mixed_texts(mixed)
    assert texts.columns == docs.columns
    got, whole = {}, {i: t for i, t, _, _ in rows}
    for r in texts.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert r["text"] and set(r["text"].split()) <= set(whole[r["doc_id"]].split())
    assert got == {i: n for i, n in taken.items() if n}


def test_defined_cases(spark, tricky, nothing):
    rows = facts(mixing.mix_sources(tricky), "doc_id", "text").collect()
    assert len(rows) == tricky.count()
    assert all(r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix_sources(nothing).count() == 0
    empty = documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])
    assert {(r["taken"], r["target"]) for r in facts(mixing.mix_sources(empty)).collect()} == {(0, 0.0)}


def test_plan_is_native(tricky):
    plan = mixing.mixed_texts(mixing.mix_sources(tricky))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
