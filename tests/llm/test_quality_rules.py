from __future__ import annotations

import base64
import collections
import random
import re

import pyarrow as pa
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from loanops.llm import quality_rules
from loanops.llm.textkit import chunks_of

from .conftest import documents, prose


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab #\n\ré\xa0", max_size=80)), max_size=12), st.integers(1, 200))
def test_counts(texts, limit):
    found = []
    for part in chunks_of(pa.array(texts, pa.string()), limit):
        counts = quality_rules.counted(part)
        found += list(zip(*[map(int, counts[n]) for n in NAMES]))
    assert found == [by_hand(t) for t in texts]


def test_bands():
    press = zstandard.ZstdCompressor(level=quality_rules.LEVEL)
    draw = random.Random(5)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er", "ing")]
    varied = " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(2000)).encode()
    assert quality_rules.compression(varied, press)[2]
    assert not quality_rules.compression(b"the same words again and again " * 400, press)[2]
    noise = bytes(draw.randrange(33, 127) for _ in range(12_000))
    assert not quality_rules.compression(noise, press)[2]
    half = varied[:6000] + b"spam spam spam " * 800
    assert quality_rules.compression(half, press)[1] >= 0.5 and not quality_rules.compression(half, press)[2]
    assert quality_rules.compression(b"short", press) == (len(press.compress(b"short")) / 5, None, True)
    assert quality_rules.compression(b"", press) == (None, None, False)


def test_encoded_and_random_text_at_every_band():
    press = zstandard.ZstdCompressor(level=quality_rules.LEVEL)
    draw = random.Random(7)
    starts = [b.from_bytes for b in quality_rules.BANDS]
    sizes = sorted({*starts, *(s - 1 for s in starts[1:]), 4096, 6000, 40_000})
    for size in sizes:
        code = base64.b64encode(draw.randbytes(size)).decode()
        lines = "\n".join(code[i : i + 76] for i in range(0, len(code), 76))
        noise = "".join(chr(draw.randrange(32, 127)) for _ in range(size))
        for text in (lines, noise):
            assert not quality_rules.compression(text[:size].encode(), press)[2], size
    # under half of the chunk bytes are encoded
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er", "ing")]
    plain = " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(4000)).encode()
    assert quality_rules.compression(plain[:16_384], press)[2]
    assert not quality_rules.compression(plain[:16_384] + lines[:8192].encode(), press)[2]


def test_defined_cases(spark, tricky, nothing):
    rows = quality_rules.judge_quality(tricky).collect()
    assert len(rows) == tricky.count()
    for r in rows:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert {r["zstd_ratio"] for r in rows if r["id"] in (4, 5)} == {None}
    assert quality_rules.judge_quality(nothing).count() == 0


def test_against_the_counts_by_hand(spark):
    texts = [prose(1, 40), prose(2, 10, 3), "a b c d e f\na b c d e f\n\n\n", None]
    rows = quality_rules.judge_quality(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).orderBy("id").collect()
    assert [tuple(r[n] for n in NAMES) for r in rows] == [by_hand(t) for t in texts]
