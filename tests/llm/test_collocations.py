from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loanops.llm import collocations
from loanops.llm.textkit import chunks_of
from tests.llm.conftest import documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, LOWER))):
        yield re.findall(r"[^\x20\x09]+", piece)


def by_hand(rows, longest=3, least=10, share=50, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: c for key, c in counts.items() if len(key[1]) > 1 and c >= least}
    out = []
    for (lang, words), a in candidates.items():
        if any(
            lg == lang and len(w) > len(words) and 100 * c >= share * a and any(w[i : i + len(words)] == words for i in range(len(w)))
            for (lg, w), c in candidates.items()
        ):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return ranked


def some_rows(seed, texts=120):
    draw = random.Random(seed)
    rows = []
    shared = ["The quick  brown fox\tjumps", "a a a a a a a a a a a a", "Éa éb, éa éb; c.d e"]
    for i in range(texts):
        words = [draw.choice("abcdefghijklmnopqrstuvwxyzé") * draw.choice([1, 1, 2]) for _ in range(draw.randrange(0, 90))]
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!?", "\r\n", "\x0b"]) for w in words)
        if draw.random() < 0.4:
            text += draw.choice(shared) * draw.randrange(1, 4)
        rows.append((i, draw.choice([text, text.upper(), None, ""]), draw.choice(["en", "en", "de", None, "und"]), "s"))
    return rows + rows[:20]


@pytest.mark.parametrize("longest,least,every", [(3, 10, 32), (3, 4, 1), (2, 6, 5), (5, 3, 7), (3, 1, 10**9)])
def test_against_brute_force(spark, longest, least, every):
    rows = some_rows(longest * 7 + least)
    got = collocations.mine_collocations(documents(spark, rows), longest=longest, least=least, every=every)
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(rows, longest, least))


def test_top_is_cut_after_ranking(spark):
    rows = some_rows(3)
    got = collocations.mine_collocations(documents(spark, rows), least=4, top=5)
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(rows, least=4, top=5))


@pytest.mark.parametrize("overlap,every", [(2, 4), (1, 1), (4, 3), (2, 10**9)])
def test_chunks_join_to_the_texts(overlap, every):
    texts = [r[1] for r in some_rows(9)]
    for part in chunks_of(pa.array(texts, pa.string()), 4000):
        rows, chunks, shared = collocations.chunks_of_texts(part, overlap, every)
        for k in range(len(part.offsets) - 1):
            own = [(c.as_py(), int(s)) for c, r, s in zip(chunks, rows, shared) if r == k]
            words, pieces = [], []
            for chunk, tail in own:
                found = re.findall(r"[^ \n]+[ \n]?", chunk)
                words += found[: len(found) - tail]
            joined = "".join(words)
            pieces = [p.split(" ") for p in joined.strip("\n").split("\n")] if joined else []
            assert pieces == [p for p in pieces_of(texts[part.first + k]) if p]


def test_copies_are_one_chunk_with_a_count(spark):
    rows = [(i, "one two three. " * 40, "en", "s") for i in range(30)]
    chunks = collocations.dictionary(documents(spark, rows), "lang", "text", 3, 8).collect()
    assert sum(c["copies"] for c in chunks) % 30 == 0 and all(c["copies"] >= 30 for c in chunks)


def test_filter_keeps_every_key(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000, dtype=np.int64)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for most in (1 << 28, 1 << 12):
        bits = collocations.bit_filter(frame, most)
        assert collocations.passes(bits, keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63, 5000, dtype=np.int64)
    assert collocations.passes(collocations.bit_filter(frame), others.view(np.uint64)).mean() < 0.05


def test_rare_hashes_travel_packed(spark, monkeypatch):
    """The hash pass sends a few bytes for a hash, not a row for each, and sums the ranges exactly."""
    words = [f"w{i}" for i in range(60_000)] + [f"c{i % 500}" for i in range(5_000)]
    rows = [(i, " ".join(words[i::50]), "en", "s") for i in range(50)]
    chunks = collocations.dictionary(documents(spark, rows), "lang", "text", 3, 32)
    sent = chunks.coalesce(1).mapInArrow(collocations._hash_counter(4), "part int, data binary").collect()
    found = [collocations.unpacked(r["data"]) for r in sent]
    keys, copies = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
    assert len(sent) == 4 and {r["part"] for r in sent} == {0, 1, 2, 3}
    assert copies.sum() == 2 * len(words) - len(rows) and sum(len(r["data"]) for r in sent) < 6 * len(keys)
    monkeypatch.setattr(collocations, "RANGE", 1 << 16)
    frequent = collocations.frequent_keys(chunks, 10).collect()
    assert sorted(r["key"] for r in frequent) == sorted(keys[copies >= 10].tolist()) and len(frequent) >= 500


def test_phrases_travel_packed(spark, monkeypatch):
    """Each range of phrases comes from a task as one compressed list for each language, whatever number of times it was merged before."""
    rows = [(i, f"alpha{i % 90} beta{i % 7} gamma{i % 11}. delta Éa {i % 300}", "en" if i % 3 else "de", "s") for i in range(6000)]
    chunks = collocations.dictionary(documents(spark, rows), "lang", "text", 3, 8)
    table = chunks.select("lang", "chunk", "shared", "copies").toArrow()
    everything = type("Bits", (), {"value": np.full(64, -1, np.int64)})
    want = Counter()
    for _, text, lang, _ in rows:
        for words in pieces_of(text):
            want[lang, 0, ""] += len(words)
            for k in range(1, 4):
                want.update((lang, k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    for held in (1 << 21, 500):
        monkeypatch.setattr(collocations, "HELD", held)
        sent = [b for half in (table[:2000], table[2000:]) for b in collocations._text_counter(everything, 3, 4)(iter(half.to_batches(max_chunksize=300)))]
        parts = pa.Table.from_batches(sent).sort_by("part")
        if held > 500:
            assert len(parts) <= 2 * 4 * 2 + 2
            assert parts["phrases"].nbytes + parts["copies"].nbytes < sum(len(p) for _, _, p in want)
        got = pa.Table.from_batches(collocations._phrase_summer(10)(iter(parts.to_batches(max_chunksize=5)))).to_pylist()
        found = {(r["lang"], r["words"], r["phrase"]): r["count"] for r in got}
        assert len(found) == len(got)
        assert found == {k: n for k, n in want.items() if n >= 10 or k[1] == 0}


def test_edge_cases(spark, tricky, nothing):
    assert collocations.mine_collocations(nothing).collect() == []
    got = collocations.mine_collocations(tricky).collect()
    rows = [tuple(r)[:4] for r in tricky.select("doc_id", "text", "lang", "source").collect()]
    assert sorted(map(tuple, got)) == sorted(by_hand(rows))
