from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loanops.llm.textkit import chunks_of, free_name, grams, owners, span_hashes, spans

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t日 ", max_size=40)), max_size=20)


def words_of(texts, limit):
    found = []
    for part in chunks_of(pa.array(texts, pa.string()), limit):
        words = spans(part)
        hashes = span_hashes(part.data, words.start, words.end)
        own = [bytes(part.data[a:b]).decode() for a, b in zip(words.start, words.end)]
        split = np.cumsum(words.counts)[:-1]
        found += list(zip(map(list, np.split(np.array(own, object), split)), np.split(hashes, split)))
    return found


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 50))
def test_words_of_chunks_are_those_of_the_pattern(texts, limit):
    found = words_of(texts, limit)
    assert [w for w, _ in found] == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    by_hash = {}
    for words, hashes in found:
        for word, value in zip(words, hashes):
            assert by_hash.setdefault(int(value), word) == word


def test_slices_and_long_words():
    column = pa.array(["skip", "x" * 600_000 + " y", None, "y"]).slice(1)
    parts = list(chunks_of(column))
    assert [p.first for p in parts] == [0, 1]
    hashes = [span_hashes(p.data, s.start, s.end) for p in parts for s in [spans(p)]]
    assert hashes[0][1] == hashes[1][0]


def test_grams_count_windows_and_short_texts():
    hashes = np.array([1, 2, 3, 4, 1, 2, 3, 9], np.uint64)
    keys, numbers = grams(hashes, np.array([4, 0, 3, 1]), 3)
    assert numbers.tolist() == [2, 0, 1, 1]
    assert keys[0] == keys[2] and len(set(keys.tolist())) == 3
    assert owners(numbers).tolist() == [0, 0, 2, 3]


def test_free_name(tricky):
    assert free_name(tricky, "shard") == "_shard" and free_name(tricky, "nobody") == "nobody"
