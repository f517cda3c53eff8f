from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from loanops.llm import language_id

from .conftest import documents

SYLLABLES = {"en": ["the", "ing", "and", "wh", "ou"], "de": ["sch", "ung", "ein", "ö", "tz"], "fr": ["eau", "eux", "que", "é", "oi"], "es": ["ción", "ñ", "dad", "ll", "os"]}


def words(language, seed, number=40):
    draw = random.Random(f"{language}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[language], k=draw.randint(1, 4))) for _ in range(number))


ROWS = [(i, words(k, i), k, f"{k}-host") for i, k in enumerate(list(SYLLABLES) * 60)]


def test_languages_of_held_out_and_wrongly_declared_texts(spark):
    wrong = [(1000 + i, words("de", 5000 + i), "fr", "fr-host") for i in range(6)]
    undeclared = [(2000 + i, words("es", 6000 + i, 8), None, None) for i in range(6)]
    short = [(3000, "ñ", "es", "es-host"), (3001, "12 34 !!", "en", "en-host"), (3002, "жук и лес над рекой где тихо", None, None)]
    rows = {r["doc_id"]: r for r in language_id.identify(documents(spark, ROWS + wrong + undeclared + short), prefix="p_").collect()}
    assert all(rows[i]["p_language"] == k and rows[i]["p_kept"] for i, _, k, _ in ROWS)
    assert all(rows[1000 + i]["p_language"] == "de" for i in range(6))
    assert all(rows[2000 + i]["p_language"] == "es" for i in range(6))
    assert rows[3000]["p_language"] == "es"
    assert rows[3001]["p_language"] == "und" and not rows[3001]["p_kept"] and rows[3001]["p_posterior"] is None
    assert rows[3002]["p_language"] == "und" and not rows[3002]["p_kept"]


def test_host_and_declared_language_decide_short_texts(spark):
    short = [(9000, "os", "es", "es-host"), (9001, "os", "en", "en-host")]
    rows = {r["doc_id"]: r for r in language_id.identify(documents(spark, ROWS + short), prefix="p_").collect()}
    alone = language_id.identify(documents(spark, ROWS + [(9000, "os", None, None)]), prefix="p_").where("doc_id = 9000").first()
    assert rows[9000]["p_posterior"] > alone["p_posterior"] > 0 and rows[9000]["p_language"] == "es"


def test_trigrams_by_hand():
    texts = ["aB, c", "", "é"]
    part = next(language_id.chunks_of(pa.array(texts)))
    buckets, counts = language_id.trigrams(part)
    want = []
    for t in texts:
        framed = b" " + bytes(language_id.LETTERS[b] for b in t.encode()) + b" "
        own = [framed[i - 1 : i + 2] for i in range(1, len(framed) - 1) if framed[i] != 32]
        want.append(own)
    assert counts.tolist() == [len(w) for w in want]
    codes = np.array([int.from_bytes(g, "big") for w in want for g in w], np.uint32)
    assert (buckets == (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - language_id.BITS)).all()


def test_suffixes_smooth_hosts(spark):
    docs = documents(spark, ROWS + [(7000, "os", None, "new-host")]).withColumn("suffix", language_id.F.expr("if(lang = 'es' or doc_id = 7000, 'es', 'org')"))
    row = language_id.identify(docs, suffix_column="suffix", prefix="p_").where("doc_id = 7000").first()
    plain = language_id.identify(docs, prefix="p_").where("doc_id = 7000").first()
    assert row["p_posterior"] >= plain["p_posterior"] and row["p_language"] == "es"


def test_defined_cases(tricky, nothing):
    rows = language_id.identify(tricky, prefix="p_").collect()
    assert len(rows) == tricky.count()
    assert {r["p_language"] for r in rows if r["doc_id"] in (4, 5, 6)} == {"und"}
    kept = language_id.keep_known_languages(tricky)
    assert kept.columns == tricky.columns
    assert kept.count() == sum(r["p_kept"] for r in rows)
    assert language_id.keep_known_languages(nothing).count() == 0
