from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, turn long, label int, score double, shard int, slot int, "
    "mix string, node long, own long, bands string, root long, language string, kept boolean, evidence string, canonical string"
)
EXTRA = (7, 8, 1, 0.5, 3, 4, "m", 5, 6, "b", 9, "l", True, "e", "c")


def documents(spark, rows):
    """Documents (doc_id, text, lang, source), with more columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows], SCHEMA)


def prose(seed: int, words: int, vocabulary: int = 300) -> str:
    """Invented prose, the same for the same seed."""
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


TRICKY = [
    (1, prose(1, 120), "en", "a"),
    (2, prose(2, 90), "en", None),
    (None, prose(3, 60), None, "b"),
    (4, None, "de", "b"),
    (5, "", "fr", "a"),
    (6, " \n\t ", "xx", "a"),
    (7, prose(4, 30_000, 5000), "en", "c"),
    (8, prose(5, 50), "es", "a"),
    (8, prose(5, 50), "es", "a"),
    (9, "one", "en", "a"),
    (10, "é ü\x00   日本語 #|<>", "en", "a"),
]


@pytest.fixture(scope="session")
def tricky(spark):
    return documents(spark, TRICKY)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
