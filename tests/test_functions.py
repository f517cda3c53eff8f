from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loanops.functions import rules, timekit
from tests.conftest import at, rows_of

NOW = "2024-03-10 12:00:00"


def one(frame, column):
    return [r[0] for r in frame.select(column.alias("x")).collect()]


def test_levels_are_inclusive_to_the_microsecond(make):
    ends = [at("2024-03-10 14:00:00"), at("2024-03-10 14:00:00.000001"), at("2024-03-10 18:00:00"), at("2024-03-10 18:00:00.000001"), None]
    frame = make("id int, x ts", enumerate(ends))
    level = timekit.level(timekit.elapsed(F.col("x"), timekit.instant(NOW)), timedelta(hours=2), timedelta(hours=6))
    assert one(frame.orderBy("id"), level) == ["L1", "L2", "L2", "L3", "L3"]


def test_elapsed_units(make):
    frame = make("a ts, b ts", [(at("2024-03-11 00:00:00"), at(NOW))])
    units = {u: one(frame, timekit.elapsed_in(F.col("a"), F.col("b"), u))[0] for u in ("hours", "days", "minutes", "seconds")}
    assert units == {"hours": 12.0, "days": 0.5, "minutes": 720.0, "seconds": 43200.0}


def test_whole_days_truncate_toward_zero(make):
    frame = make("a ts, b ts", [(at("2024-03-01 00:00:00"), at("2024-03-03 06:00:00"))])
    assert one(frame, timekit.whole_days(F.col("a"), F.col("b"))) == [-2]
    assert one(frame, timekit.whole_days(F.col("b"), F.col("a"))) == [2]


def test_month_start_crosses_years():
    assert timekit.month_start("2024-01-20") == datetime(2024, 1, 1)
    assert timekit.month_start("2024-01-20", 1) == datetime(2023, 12, 1)
    assert timekit.month_start("2024-01-20", 13) == datetime(2022, 12, 1)
    with pytest.raises(ValueError):
        timekit.as_instant("2024-01-20T00:00:00+05:30")


def test_lookbacks(make):
    frame = make("id int, x ts", [(1, at("2024-03-05 00:00:00")), (2, at("2024-03-04 23:59:59")), (3, at("2024-03-05 13:00:00")), (4, None)])
    assert rows_of(frame.filter(timekit.since_day(F.col("x"), NOW, 5)).select("id")) == [(1,), (3,)]
    assert rows_of(frame.filter(timekit.since_instant(F.col("x"), NOW, 5)).select("id")) == [(3,)]


def test_business_window_is_open_at_both_ends(make):
    # 12:30 business time is 07:00 UTC.
    times = ["2024-03-09 07:00:00", "2024-03-09 07:00:00.000001", "2024-03-10 06:59:59.999999", "2024-03-10 07:00:00"]
    frame = make("id int, x ts", enumerate(at(x) for x in times))
    assert rows_of(frame.filter(timekit.business_day_window(F.col("x"), NOW)).select("id")) == [(1,), (2,)]


def test_late_arrivals(make):
    rows = [
        (1, at("2024-03-10 23:00:00"), None),
        (2, at("2024-03-09 10:00:00"), at("2024-03-10 09:00:00")),
        (3, at("2024-03-09 10:00:00"), at("2024-03-10 09:00:01")),
        (4, at("2024-03-11 00:00:00"), at("2024-03-12 00:00:00")),
    ]
    frame = make("id int, paid ts, updated ts", rows)
    kept = frame.filter(timekit.on_day_or_late(F.col("paid"), F.col("updated"), NOW))
    assert rows_of(kept.select("id")) == [(1,), (3,)]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "e"))
    frame = spark.read.parquet(str(tmp_path / "e"))
    for test in (
        timekit.since_day(F.col("ts"), "2024-01-20", 5),
        timekit.same_day(F.col("ts"), "2024-01-20"),
        timekit.business_day_window(F.col("ts"), "2024-01-20"),
    ):
        plan = frame.filter(test).select("event_id", "ts")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan" in plan.split("PushedFilters")[1]
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_periods_and_business_time(make):
    frame = make("x ts", [(at("2024-03-31 18:30:00"),)])
    local = timekit.to_business_time(F.col("x"))
    assert one(frame, local) == [at("2024-04-01 00:00:00")]
    assert one(frame, timekit.period(local, "M")) == ["2024-04"]
    assert one(frame, timekit.period(F.col("x"), "D")) == ["2024-03-31"]
    assert one(frame, timekit.trunc("week", F.col("x"))) == [at("2024-03-25 00:00:00")]
    assert one(frame, timekit.day("2024-03-10")) == [date(2024, 3, 10)]


def test_last_match_wins(make):
    frame = make("x int", [(1,), (5,), (20,), (None,)])
    chain = rules.last_match([(F.col("x") > 0, "some"), (F.col("x") > 10, "many"), (F.col("x") == 5, "five")], "none")
    assert one(frame.orderBy("x"), chain) == ["none", "some", "five", "many"]


def test_stage_prefers_the_last_of_three_matches(make):
    rows = [
        (1, 1, None, 0.0, 0.0, None, "MFC Fetch"),
        (2, None, 9, 0.0, 0.0, "IN_PROGRESS", "Pre Fetch"),
        (3, 1, 9, 5.0, 0.0, "IN_PROGRESS", "Post Fetch"),
        (4, 1, 9, 5.0, 2.0, "IN_PROGRESS", "Post Pledge"),
        (5, 1, 9, 5.0, 0.0, "COMPLETED", "Completed"),
        (6, 1, 9, 5.0, 2.0, "OTHER", "Pre Fetch"),
    ]
    frame = make("id int, l long, a long, v double, p double, s string, want string", rows)
    stage = rules.application_stage(*[F.col(c) for c in "lavps"])
    assert frame.filter(~stage.eqNullSafe(F.col("want"))).count() == 0


def test_eligible_limit_edges(make):
    rows = [(24999.99, 25000.0, 25000.0), (25000.0, 90000.0, 25000.0), (None, 24999.99, 0.0), (None, None, 0.0)]
    frame = make("a double, l double, want double", rows)
    assert frame.filter(rules.eligible_limit(F.col("a"), F.col("l")) != F.col("want")).count() == 0


def test_nan_counts_as_missing(make):
    frame = rules.nan_to_null(make("a double, n int", [(float("nan"), 1), (30000.0, 2)]))
    assert one(frame.orderBy("n"), rules.eligible_limit(F.col("a"), F.lit(0))) == [0.0, 30000.0]


def test_channel(make):
    rows = [
        (9, None, None, "B2B"),
        (1, 5, "INDIVIDUAL", "B2B2C"),
        (None, 5, "INDIVIDUAL", "B2B2C"),
        (1, 5, None, "B2C"),
        (None, 5, "COMPANY", "B2C"),
        (None, None, "INDIVIDUAL", "B2C"),
    ]
    frame = make("pl int, pa int, kind string, want string", rows)
    channel = rules.business_channel(F.col("pl"), F.col("pa"), F.col("kind"), [1, 2])
    assert frame.filter(channel != F.col("want")).count() == 0


def test_platform_type_of_null_is_other(make):
    frame = make("x string", [("A",), ("B",), (None,)])
    kind = rules.platform_type(F.col("x"), {"first": ["A"], "second": ["B"]})
    assert sorted(one(frame, kind)) == ["Other", "first", "second"]
    assert one(frame, rules.platform_type(F.col("x"), {})) == ["Other"] * 3


def test_text_rules(make):
    frame = make("x string", [("  12 \t",), ("",), (None,), ("   ",)])
    assert one(frame, rules.trimmed(F.col("x"))) == ["12", "", None, ""]
    assert one(frame, rules.bracketed(rules.trimmed(F.col("x")))) == ["[12]", "", None, ""]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("09876543210", "9876543210"),
        ("+91 98765 43210", "9876543210"),
        ("9876543210", "9876543210"),
        ("9187654321", "9187654321"),
        ("5876543210", None),
        ("12345", None),
        ("0", None),
        (None, None),
    ],
)
def test_phone(make, raw, want):
    assert one(make("x string", [(raw,)]), rules.valid_phone(F.col("x"))) == [want]


def test_json_and_ratio(make):
    frame = make("j string, a long, b long", [('{"k": "v", "n": 3}', 6, 4), (None, 6, 0)])
    assert one(frame, rules.json_text(F.col("j"), "k")) == ["v", None]
    assert one(frame, rules.json_text(F.col("j"), "n")) == ["3", None]
    assert one(frame, rules.safe_ratio(F.col("a"), F.col("b"))) == [1.5, None]


def test_value_by_id(make):
    frame = make("x array<struct<id:bigint,value:string>>", [([(1, "a"), (2, "b"), (2, "c")],), ([],), (None,)])
    assert one(frame, rules.value_by_id(F.col("x"), 2)) == ["b", None, None]


def test_flatten_and_blanks(spark):
    frame = spark.sql("select struct(1 as a, struct(cast(null as string) as c) as b) as s, 'x' as t")
    flat = rules.flatten(frame)
    assert flat.columns == ["s.a", "s.b.c", "t"]
    assert [tuple(r) for r in rules.blank_nulls(flat).collect()] == [("1", "", "x")]
