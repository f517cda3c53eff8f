"""Runs that are published whole or not at all, files by lender, ticket fields without a schema, zones by name."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loanops.functions.rules import flatten
from loanops.functions.timekit import to_zone
from loanops.sources import sinks
from loanops.sources.ticket_pages import found_schema, parse_pages
from tests.conftest import at, rows_of


def _reports(make, tag, titles=("First one", "Second", "Third")):
    return {t: make("a long, t string", [(i, tag) for i in range(3)]) for t in titles}


def _published(spark, folder):
    return {title: rows_of(f) for title, f in sinks.read_published(spark, folder).items()}


def test_a_failing_report_leaves_the_last_run(spark, make, tmp_path):
    folder = str(tmp_path / "out")
    assert sinks.read_published(spark, folder) == {}
    assert sinks.publish_run(_reports(make, "old"), folder) == 1
    old = _published(spark, folder)
    broken = _reports(make, "new")
    broken["Third"] = broken["Third"].select("a", F.when(F.col("a") == 2, F.raise_error(F.lit("broken"))).otherwise("t").alias("t"))
    with pytest.raises(PySparkException):
        sinks.publish_run(broken, folder)
    assert _published(spark, folder) == old == {t: [(0, "old"), (1, "old"), (2, "old")] for t in ("First one", "Second", "Third")}


def test_runs_replace_each_other_whole(spark, make, tmp_path):
    folder = str(tmp_path / "out")
    for number, titles in enumerate((("A", "B"), ("B", "C"), ("C",)), 1):
        assert sinks.publish_run(_reports(make, f"run {number}", titles), folder) == number
        assert set(_published(spark, folder)) == set(titles)
    assert _published(spark, folder)["C"][0] == (0, "run 3")


def test_titles_of_one_table_name_are_refused(make, tmp_path):
    with pytest.raises(ValueError):
        sinks.publish_run(_reports(make, "x", ("A b", "a B")), str(tmp_path))


def _csv(spark, folder):
    return spark.read.options(**sinks.CSV).schema("lender_id string, v long, lender string").csv(folder)


def test_other_lenders_stay(spark, make, tmp_path):
    folder = str(tmp_path / "out")
    rows = [("Alpha", 1), ("Beta", 2), (None, 3), ("Gamma", 4)]
    sinks.write_per_lender(make("lender_id string, v long", rows), folder)
    sinks.write_per_lender(make("lender_id string, v long", [("Beta", 20), ("Delta", 50)]), folder, keep_others=True)
    assert rows_of(_csv(spark, folder).select("lender_id", "v")) == sorted([("Alpha", 1), ("Beta", 20), (None, 3), ("Gamma", 4), ("Delta", 50)], key=repr)
    sinks.write_per_lender(make("lender_id string, v long", [("Beta", 21)]), folder)
    assert rows_of(_csv(spark, folder).select("lender_id", "v")) == [("Beta", 21)]


def test_files_of_a_lender_are_few_and_bounded(spark, tmp_path):
    frame = spark.range(3000, numPartitions=20).select(F.when(F.col("id") % 3 > 0, "Alpha").otherwise("Beta").alias("lender_id"), F.col("id").alias("v"))
    sinks.write_per_lender(frame, f"{tmp_path}/few", order=[F.desc("v")])
    sinks.write_per_lender(frame, f"{tmp_path}/bounded", order=[F.desc("v")], rows_per_file=300)
    for lender, rows in (("Alpha", 2000), ("Beta", 1000)):
        assert len(list(Path(f"{tmp_path}/few/lender={lender}").glob("*.csv"))) == 1
        files = list(Path(f"{tmp_path}/bounded/lender={lender}").glob("*.csv"))
        assert len(files) == -(-rows // 300) and all(len(f.read_text().splitlines()) <= 301 for f in files)
    values = [int(line.split(",")[1]) for line in next(Path(f"{tmp_path}/few/lender=Beta").glob("*.csv")).read_text().splitlines()[1:]]
    assert values == sorted(values, reverse=True)


PAGES = [
    (1, '{"tickets": [{"id": 1, "via": {"channel": "mail"}, "odd `name` x": 1.5}], "links": {"next": null}}'),
    (2, '{"tickets": [{"id": 2, "via": {"rank": 7, "channel": "web"}, "mixed": 1}, {"id": 3, "mixed": [1]}], "count": 2}'),
    (3, "no document"),
    (4, None),
    (5, "[1, 2]"),
    (6, '{"tickets": []}'),
]


def test_fields_are_those_of_the_documents(make):
    pages = make("n long, t string", PAGES)
    rows = flatten(parse_pages(pages, "t", "n", schema=None))
    assert rows.columns == ["page", "position", "id", "mixed", "odd `name` x", "via.channel", "via.rank"]
    found = rows.withColumn("mixed", F.col("mixed").cast("string")).collect()
    assert sorted(map(tuple, found), key=lambda r: r[:2]) == [
        (1, 0, 1, None, 1.5, "mail", None),
        (2, 0, 2, "1", None, "web", 7),
        (2, 1, 3, "[1]", None, None, None),
    ]


@pytest.mark.parametrize("texts", [[], [None, "x"], ["[1]"], ["{}"], ['{"tickets": 5}']])
def test_documents_without_tickets(make, texts):
    pages = make("n long, t string", list(enumerate(texts)))
    rows = parse_pages(pages, "t", "n", schema=None)
    assert rows.columns[:3] == ["page", "position", "id"] and rows.collect() == []


def test_found_schema(make):
    pages = make("t string", [('{"a": 1, "b": {"c": null}}',), ('{"a": 2.5, "d": "it\'s"}',)])
    found = found_schema(pages, "t")
    assert found.names == ["a", "b", "d"] and found["a"].dataType.typeName() == "decimal"
    assert found["b"].dataType.simpleString() == "struct<c:string>"


def test_zones_follow_the_change_of_the_clock(make):
    moments = [at("2024-03-31 00:59:59"), at("2024-03-31 01:00:00"), at("2024-10-27 00:59:59"), at("2024-10-27 01:00:00"), None]
    frame = make("x ts", [(m,) for m in moments]).select(to_zone(F.col("x"), "Europe/Berlin").alias("b"), to_zone(F.col("x"), "UTC", "Asia/Kolkata").alias("u"))
    got = [tuple(r) for r in frame.collect()]
    assert got == [
        (at("2024-03-31 01:59:59"), at("2024-03-30 19:29:59")),
        (at("2024-03-31 03:00:00"), at("2024-03-30 19:30:00")),
        (at("2024-10-27 02:59:59"), at("2024-10-26 19:29:59")),
        (at("2024-10-27 02:00:00"), at("2024-10-26 19:30:00")),
        (None, None),
    ]
