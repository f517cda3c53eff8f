from __future__ import annotations

import pytest

from loanops.llm.queries import ORACLES, QUERIES
from workload import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) is None


# Queries that return something else than one row for each row of their table.
PARTS = ("op7_decontamination", "op11_chat_windows", "op12_collocations")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(PARTS)))
def test_runs_over_whole_tables(spark, name):
    whole = spark.read.parquet(f"{FOLDER}/{'pages' if name == 'op3_url_filter' else 'documents'}.parquet").count()
    assert QUERIES[name](spark, FOLDER).count() == whole


def test_decontamination_finds_some(spark):
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0 < QUERIES["op7_decontamination"](spark, FOLDER).count() < whole
