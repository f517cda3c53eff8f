from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from loanops.llm import periodic_runs
from loanops.llm.queries import QUERIES
from tests.llm.conftest import documents


def runs_by_hand(words, shortest=6, power=4):
    """Every maximal stretch of every period, kept if no smaller period holds."""
    found, n = [], len(words)
    for q in range(1, n // power + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        at = 0
        while at < len(same):
            if not same[at]:
                at += 1
                continue
            until = at
            while until < len(same) and same[until]:
                until += 1
            length = until - at + q
            stretch = words[at : at + length]
            least = all(any(stretch[k] != stretch[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(shortest, power * q) and least:
                found.append((at, length, q))
            at = until
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(seed):
    draw = random.Random(seed)
    letters = draw.choice([2, 2, 3, 5, 40])
    words = [draw.randrange(letters) for _ in range(draw.randrange(0, 30))]
    for _ in range(draw.randrange(4)):
        block = [draw.randrange(letters) for _ in range(draw.randrange(1, 9))]
        words += block * draw.randrange(1, 7) + block[: draw.randrange(len(block))]
        words += [draw.randrange(letters) for _ in range(draw.randrange(0, 12))]
    return words


@pytest.mark.parametrize("limits", [(6, 4), (1, 3), (12, 2), (40, 3), (9, 5)])
def test_automaton_finds_every_run(limits):
    for seed in range(400):
        words = some_words(seed)
        found = sorted(periodic_runs.runs_of(words, *limits), key=lambda r: (r[0], r[2]))
        assert found == runs_by_hand(words, *limits), (seed, words)


@pytest.mark.parametrize("limits", [(6, 4), (1, 3), (12, 2), (40, 3), (9, 5)])
def test_every_run_lies_in_a_stretch(limits):
    for seed in range(300):
        texts = [some_words(1000 + seed * 3 + k) for k in range(3)]
        hashes = np.array([w for t in texts for w in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        owner = np.repeat(np.arange(3), [len(t) for t in texts])
        cut = periodic_runs.stretches(hashes, owner, *limits)
        found = []
        for low, high in cut:
            text = int(owner[low])
            assert (owner[low:high] == text).all()
            base = low - sum(len(t) for t in texts[:text])
            own = texts[text][base : base + high - low]
            found += [(text, base + s, n, q) for s, n, q in periodic_runs.runs_of(own, *limits)]
        assert sorted(found, key=lambda r: (r[0], r[1], r[3])) == [(k, *r) for k, t in enumerate(texts) for r in runs_by_hand(t, *limits)]


def test_prose_enters_no_automaton():
    draw = random.Random(5)
    words = np.array([draw.randrange(50_000) for _ in range(20_000)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert periodic_runs.stretches(words, np.zeros(20_000, int)) == []


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = runs_by_hand([ids[w] for w in words])
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i, " ".join(f"w{w}é" for w in some_words(i)), "en", "a") for i in range(300)]
    rows += [(None, "a a a a a a a", None, None), (None, "a a a a a a a", None, None), (301, None, "en", "a"), (302, " \n\t", "en", "a")]
    rows += [(303, "x\x0by  z\n" * 9 + "     ", "en", "a"), (304, ("long word " * 3 + "tail ") * 4000, "en", "a"), (304, "b " * 6, "en", "a")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert set(COLUMNS) <= set(got.columns)
    long = [r for r in rows if r[0] == 304 and len(r[1]) > 1000]
    short = [r for r in rows if r not in long]
    mine = sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)
    theirs = sorted([expected(i, t) for i, t, _, _ in short], key=repr)
    big = [r for r in mine if r[0] == 304 and r[3] and r[3] > 1000]
    assert [r for r in mine if r not in big] == theirs
    assert len(big) == 1 and big[0][1:5] == (big[0][1], 0, 28_000, 7)


def test_tables_of_edge_cases(spark, tricky, nothing):
    assert periodic_runs.find_runs(nothing).collect() == []
    rows = {(r["id"], r["n_words"]) for r in periodic_runs.find_runs(tricky).collect()}
    assert (7, 30_000) in rows and (4, 0) in rows and (5, 0) in rows and (6, 0) in rows and (None, 60) in rows


def test_whole_table(spark):
    """Every document of the smallest given table against brute force, where that is quick."""
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        if len(text or "") < 3000:
            assert got[i] == expected(i, text)
