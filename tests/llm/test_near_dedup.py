from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from loanops.llm import near_dedup

from .conftest import documents, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else collections.Counter([tuple(words)])


def classes_by_hand(rows, similarity=0.8):
    """All pairs; ids must be distinct."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = sum((sets[a] & sets[b]).values())
            if shared >= similarity * (sum(sets[a].values()) + sum(sets[b].values()) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(text, edits, draw):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_signature_agreement_is_weighted_similarity():
    draw = random.Random(3)
    rates, truth = [], []
    for turn in range(30):
        a = {near_dedup.mix_int(turn * 1000 + i): draw.choice([0.5, 1, 1, 2, 3.7]) for i in range(40)}
        b = {k: (w + draw.choice([0, 0, 0.6, 2])) for k, w in list(a.items())[draw.randrange(12) :]}
        keys = [k for k in a] + [k for k in b]
        owner = np.array([0] * len(a) + [1] * len(b))
        signed = near_dedup.dart_signatures(owner, np.array(keys, np.uint64), np.array([*a.values(), *b.values()], float), 2)
        rates.append((signed[0] == signed[1]).mean())
        truth.append(sum(min(a.get(k, 0), b.get(k, 0)) for k in a) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}))
    assert np.mean(rates) == pytest.approx(np.mean(truth), abs=0.02)
    assert np.abs(np.array(rates) - truth).max() < 0.2


def test_heavy_and_light_elements_fill_every_coordinate():
    signed = near_dedup.dart_signatures(np.array([0, 1, 1]), np.array([5, 5, 6], np.uint64), np.array([1e-3, 1e5, 1.0]), 3)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (signed[:2] != empty).all() and (signed[2] == empty).all()


@pytest.mark.parametrize("small,nodes,broadcast", [(8, 256, 10**6), (1, 4, 0)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, small, nodes, broadcast):
    """Also with nearly all buckets dealt into blocks, and with every lookup joined by shuffle."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", nodes)
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", broadcast)
    draw = random.Random(9)
    rows = []
    for group in range(30):
        base = prose(group, draw.choice([6, 30, 150, 400]), 5000)
        rows += [(base, k) for k in range(draw.choice([1, 2, 5]))]
        rows += [(edited(base, draw.choice([1, 2, 4, 8]), draw), 0) for _ in range(draw.randint(0, 6))]
        rows += [(base + " " + prose(1000 + group, 200, 5000), 0)]
    rows = [(i, t) for i, (t, _) in enumerate(rows)]
    draw.shuffle(rows)
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    got = {r["id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == classes_by_hand(rows)


@pytest.mark.parametrize("nodes", [256, 5])
def test_chains_in_one_bucket_are_joined(spark, monkeypatch, nodes):
    """Neighbours of the chain are similar, its ends are not, and a crowd of copies shares their bands."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", nodes)
    words = prose(1, 300, 5000).split()
    chain = [" ".join(f"c{j}" if j < 12 * k else w for j, w in enumerate(words)) for k in range(12)]
    rows = list(enumerate(chain + [chain[3]] * 40))
    got = {r["id"]: r["class_id"] for r in near_dedup.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in rows])).collect()}
    assert got == classes_by_hand(rows) == {i: 0 for i, _ in rows}


def test_block_similarity_and_forest(monkeypatch):
    draw = random.Random(5)
    texts = [prose(k, draw.randint(0, 30), 6) for k in range(12)] + ["a a a a a a a a a", None]
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    got = near_dedup.block_similarity(pa.array(texts[:8]), pa.array(texts[4:]))
    for i, a in enumerate(texts[:8]):
        for j, b in enumerate(texts[4:]):
            x, y = (shingles(t) if t else collections.Counter() for t in (a, b))
            shared = sum((x & y).values())
            assert got[i, j] == pytest.approx(shared / max(1, sum((x | y).values())))
    assert near_dedup.forest(np.array([1, 1, 2, 3]), np.array([[0, 1], [0, 2], [1, 2], [2, 3], [0, 3]])) == [1, 3]


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_defined_cases(spark, tricky, nothing):
    rows = near_dedup.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    assert {r["class_id"] for r in rows if r["id"] in (4, 5, 6)} == {4}
    kept = near_dedup.drop_near_duplicates(tricky)
    assert kept.columns == tricky.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, None, 4, 7, 8, 9, 10], key=str)
    assert near_dedup.drop_near_duplicates(nothing).count() == 0
    same_id = documents(spark, [(1, prose(1, 50), "en", "a"), (1, prose(2, 50), "en", "a"), (None, prose(1, 50), "en", "a")])
    assert sorted(r["text"] for r in near_dedup.drop_near_duplicates(same_id).collect()) == sorted([prose(1, 50), prose(2, 50)])
