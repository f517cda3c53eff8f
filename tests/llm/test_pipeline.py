from __future__ import annotations

import random
import re

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from loanops.llm.queries import ORACLES, QUERIES
from loanops.llm.textkit import settled

from .conftest import documents
from .test_language_id import words as sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with exact and near copies, a test item, texts of no language and other rows to defend against."""
    place = tmp_path_factory.mktemp("corpus")
    draw = random.Random(8)
    rows = [(i, sentence(k, i, draw.randint(20, 200)), k, draw.choice("aaabcd")) for i, k in enumerate(["en", "de", "fr", "es"] * 50)]
    item = sentence("en", 99_999, 30)
    rows += [(1000 + i, rows[i][1], rows[i][2], "e") for i in range(0, 60, 3)]
    rows += [(2000 + i, rows[i][1] + " theing wh.", rows[i][2], "e") for i in range(1, 40) if len(rows[i][1].split()) > 40]
    rows += [(3000 + i, f"{sentence('en', 700 + i, 80)} {item} {sentence('en', 800 + i, 20)}", "en", "a") for i in range(5)]
    rows += [(4000, None, "en", "a"), (4001, "", None, None), (4002, "123 456", "en", "a"), (None, sentence("en", 4003, 50), "en", None)]
    documents(spark, rows).drop("shard", "slot", "mix").repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, item), (2, sentence("fr", 88_888, 25)), (3, None)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return str(place), rows


def test_stages(spark, folder):
    place, rows = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = settled(stage(spark, docs, place))
        seen[name] = after
        if name != "sharding":
            assert after.columns == docs.columns
        docs = after
    ids = {k: [r["doc_id"] for r in f.select("doc_id").collect()] for k, f in seen.items()}
    assert set(i for i, *_ in rows) - set(ids["language_id"]) == {4000, 4001, 4002}
    assert len(ids["language_id"]) == len(rows) - 3
    gone = set(ids["language_id"]) - set(ids["near_dedup"])
    assert {i for i in gone} == {i for i, *_ in rows if i is not None and 1000 <= i < 3000}
    assert set(ids["near_dedup"]) - set(ids["decontamination"]) == {3000 + i for i in range(5)}
    texts = {r["doc_id"]: r["text"] for r in seen["decontamination"].collect()}
    size = sum(len(WORD.findall(t)) for t in texts.values())
    mixed = seen["mixing"].collect()
    assert abs(sum(len(WORD.findall(r["text"])) for r in mixed) - 1.5 * size) < 0.02 * size
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
    assert sorted(ids["sharding"], key=str) == sorted(ids["mixing"], key=str)
    by_shard = {}
    for r in seen["sharding"].collect():
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert len(by_shard) == 8 and all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_run_is_the_stages_after_one_another(spark, folder):
    place, _ = folder
    one, two = ({(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, place).collect()} for _ in range(2))
    assert one == two and len(one) > 200


def test_empty_tables(spark, tmp_path, nothing):
    nothing.drop("shard", "slot", "mix").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_point_has_them():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLES) <= set(entry_point.oracle_sql())
    assert [n for k in range(1, 11) for n in QUERIES if n.startswith(f"op{k}_")] == [n for n in sorted(QUERIES, key=lambda n: int(re.search(r"\d+", n)[0])) if n.startswith("op")]
