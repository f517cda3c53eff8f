"""Hand-made rows for the cubes and the scoreboard; values worked out by hand."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.plans import sla
from loanops.sources import sinks
from tests.conftest import at, rows_of

NOW = "2024-03-10 12:00:00"
TERMS = sla.LenderTerms(
    lien_removal={"Alpha": timedelta(days=5), "Beta": timedelta(days=7)},
    foreclosure={"Alpha": timedelta(days=7), "Beta": timedelta(days=5)},
    opening={"Alpha": timedelta(minutes=30), "Beta": timedelta(hours=4)},
    lodged={"Alpha": timedelta(minutes=15), "Beta": timedelta(hours=2)},
    unlodged={"Alpha": timedelta(minutes=30), "Beta": timedelta(hours=4)},
)
REQUESTS = "request_id int, credit_id int, status string, created_on ts, last_updated_on ts"


@pytest.fixture(scope="module")
def enhancements(make):
    day = "2024-03-09 "
    return make(
        REQUESTS,
        [
            # due at 10:00
            (1, 1, "SUCCESS", at(day + "08:00:00"), at(day + "10:00:00")),
            (2, 1, "SUCCESS", at(day + "08:00:00"), at(day + "10:00:00.000001")),
            (3, 1, "SUCCESS", at(day + "08:00:00"), at(day + "12:00:00")),
            (4, 1, "SUCCESS", at(day + "08:00:00"), at(day + "16:00:00")),
            (5, 1, "SUCCESS", at(day + "08:00:00"), at(day + "16:00:00.000001")),
            (6, 1, "SUCCESS", at(day + "08:00:00"), None),
            (7, 1, "REQUESTED", at("2024-03-10 10:00:00"), at("2024-03-10 10:00:00")),
            (8, 1, "REQUESTED", at("2024-03-10 09:59:59"), at("2024-03-10 09:59:59")),
            (9, 1, "FAILED", at(day + "08:00:00"), at(day + "09:00:00")),
            (10, 1, "ODD", at(day + "08:00:00"), at("2024-03-10 06:00:00")),
            (11, 1, None, at(day + "08:00:00"), None),
            (12, 1, "SUCCESS", at("2024-01-29 23:59:59"), at("2024-01-30 00:00:00")),
            (13, 1, "SUCCESS", at("2024-01-30 00:00:00"), at("2024-01-30 00:00:00")),
        ],
    )


def test_request_labels(enhancements):
    items = sla.enhancement_items({"enhance_limit_request": enhancements})
    judged = sla.judge(items, sla.ENHANCEMENT, NOW)
    shown = judged.select("request_id", "verdict", "time_delay_till_today", "delay_in_settlement", "delay_in_not_settlement")
    assert {r[0]: tuple(r)[1:] for r in shown.collect()} == {
        1: ("YES", None, None, None),
        2: ("NO", None, "L1", None),
        3: ("NO", None, "L1", None),
        4: ("NO", None, "L2", None),
        5: ("NO", None, "L3", None),
        6: ("YES", None, None, None),
        7: ("NOT SETTLED NO SLA BREACHED", "L1", None, None),
        8: ("NOT SETTLED SLA BREACHED", "L2", None, "L1"),
        9: ("FAILED", "L3", None, None),
        10: ("YES", "L2", None, None),
        11: ("YES", "L3", None, None),
        13: ("YES", None, None, None),
    }


def test_cube_counts_every_row_of_the_lookback(enhancements):
    cube = sla.enhancements({"enhance_limit_request": enhancements}, NOW)
    assert cube.agg(F.sum("count")).first()[0] == 12
    assert cube.columns == ["created_on_date", "settled_under_time", "time_delay_till_today", "delay_in_settlement", "count"]


def test_unknown_deadline_ends_as_in_time(make):
    rows = [
        (1, 1, "PENDING", at("2024-03-01 00:00:00"), at("2024-03-01 00:00:00"), None),
        (2, 1, "SETTLED", at("2024-03-01 00:00:00"), at("2024-03-09 00:00:00"), None),
        (3, 1, "REQUESTED", at("2024-03-01 00:00:00"), None, at("2024-03-02 00:00:00")),
        (4, 1, "PENDING", at("2024-03-01 00:00:00"), None, at("2024-03-02 00:00:00")),
        (5, 1, "CANCELLED", at("2024-03-01 00:00:00"), None, None),
    ]
    schema = "collection_id int, credit_id int, collection_status string, created_on ts, last_updated_on ts, settlement_expected_by ts"
    judged = sla.judge(make(schema, rows), sla.REPAYMENT, NOW)
    assert rows_of(judged.select("collection_id", "verdict")) == [
        (1, "YES"),
        (2, "YES"),
        (3, "REQUESTED"),
        (4, "NOT SETTLED SLA BREACHED"),
        (5, "FAILED"),
    ]


def test_foreclosure_counts_equal_rows_once_and_skips_other_lenders(make):
    row = (1, 1, "SUCCESS", at("2024-03-01 00:00:00"), at("2024-03-02 00:00:00"), "Alpha")
    other = (2, 1, "SUCCESS", at("2024-03-01 00:00:00"), at("2024-03-02 00:00:00"), "Gamma")
    t = {"foreclosure_requests": make(REQUESTS + ", lender_id string", [row, row, other])}
    assert [r["count"] for r in sla.foreclosures(t, TERMS, NOW).collect()] == [1]
    assert [r["count"] for r in sla.foreclosures(t, TERMS, NOW, request_id_unique=True).collect()] == [2]


@pytest.fixture(scope="module")
def credits(make):
    created = at("2024-03-09 08:00:00")
    main = [
        (1, C.ACTIVE, "Alpha", created),
        (2, C.ACTIVE, "Alpha", created),
        (3, C.PENDING_DISBURSAL_APPROVAL, "Alpha", created),
        (4, C.PENDING_DISBURSAL_APPROVAL, "Beta", at("2024-03-10 11:00:00")),
        (5, C.PENDING_DISBURSAL_APPROVAL, "Gamma", created),
        (6, C.PENDING_LODGEMENT, "Beta", created),
        (7, C.ACTIVE, "Gamma", created),
    ]
    audit = [
        (1, C.PENDING_LODGEMENT, at("2024-03-09 08:30:00")),
        (1, C.ACTIVE, at("2024-03-09 09:00:00")),
        (2, C.PENDING_LODGEMENT, at("2024-03-09 11:00:00")),
        (6, C.PENDING_LODGEMENT, at("2024-03-10 11:00:00")),
        (6, C.PENDING_DISBURSAL_APPROVAL, at("2024-03-09 08:00:00")),
    ]
    return {
        "credit_main": make("credit_id int, credit_status string, lending_partner_id string, created_on ts", main),
        "credit_audit": make("credit_id int, credit_status string, last_updated_on ts", audit),
    }


def _verdicts(credits, spec):
    judged = sla.judge(sla.credit_timeline(credits, TERMS), spec, NOW)
    shown = judged.select("credit_id", "verdict", "time_delay_till_today", "delay_in_settlement", "delay_in_not_settlement")
    return {r[0]: tuple(r)[1:] for r in shown.collect()}


def test_account_opening(credits):
    assert _verdicts(credits, sla.OPENING) == {
        1: ("YES", None, None, None),
        2: ("NO", None, "L2", None),
        3: ("NOT SETTLED SLA BREACHED", "L3", None, "L2"),
        4: ("NOT SETTLED NO SLA BREACHED", "L3", None, None),
        5: ("DONT KNOW", "L3", None, None),
        6: ("NO", None, "L2", None),
        7: ("YES", None, None, None),
    }


def test_lodgement_is_in_time_once_lodged(credits):
    got = _verdicts(credits, sla.LODGEMENT)
    assert {k: v[0] for k, v in got.items()} == {
        1: "YES",
        2: "YES",
        3: "NOT SETTLED SLA BREACHED",
        4: "NOT SETTLED NO SLA BREACHED",
        5: "DONT KNOW",
        6: "NOT SETTLED NO SLA BREACHED",
        7: "YES",
    }
    assert got[6][1:] == ("L3", None, None)


def _board(frame):
    return {(r["lender_id"], r["channel_type"]): tuple(r[c] for c in sla.BOARD_COUNTS) for r in frame.collect()}


def test_scoreboard_edges(make):
    today = "2024-03-10 "
    rows = [
        # done today, due two hours after creation
        (1, 1, "SUCCESS", at(today + "08:00:00"), at(today + "10:00:00")),
        (2, 1, "SUCCESS", at(today + "07:00:00"), at(today + "11:00:00")),
        (3, 1, "SUCCESS", at(today + "03:00:00"), at(today + "11:00:00")),
        (4, 1, "SUCCESS", at(today + "01:00:00"), at(today + "11:00:00")),
        (5, 1, "SUCCESS", at("2024-03-09 01:00:00"), at("2024-03-09 23:59:59")),
        # waiting
        (6, 1, "FAILED", at(today + "11:00:00"), at(today + "11:00:00")),
        (7, 1, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-09 12:00:00")),
        (8, 1, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-09 11:59:59")),
        (9, 1, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-05 12:00:00")),
        (10, 1, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-05 11:59:59")),
        (11, 1, "REQUESTED", at("2024-03-01 00:00:00"), None),
        # unknown lender on both halves
        (12, 99, "SUCCESS", at(today + "08:00:00"), at(today + "09:00:00")),
        (13, 99, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-10 11:00:00")),
    ]
    t = {
        "enhance_limit_request": make(REQUESTS, rows),
        "credits": make("credit_id int, lending_partner_id string", [(1, "Alpha"), (2, "Beta")]),
    }
    out = sla.enhancement_arm(t, NOW)
    assert rows_of(out.select("lender_id", *sla.BOARD_COUNTS)) == sorted(
        [
            ("Alpha", 1, 1, 1, 1, 1, 1, 1, 1, 1),
            (None, 1, 0, 0, 0, 0, 0, 0, 0, 0),
            (None, 0, 0, 0, 0, 0, 1, 0, 0, 0),
        ],
        key=repr,
    )
    assert {r[0] for r in out.select("update_date").collect()} == {at("2024-03-10 00:00:00")}


def test_repayment_buckets_overlap(make):
    schema = "collection_id int, credit_id int, collection_status string, created_on ts, last_updated_on ts, settlement_expected_by ts"
    due = at("2024-03-09 12:00:00")
    rows = [
        (1, 1, "SETTLED", at("2024-03-09 00:00:00"), at("2024-03-10 08:00:00"), due),
        (2, 1, "SETTLED", at("2024-03-09 00:00:00"), at("2024-03-10 08:00:00"), None),
        (3, 1, "FAILED", at("2024-03-09 00:00:00"), at("2024-03-10 08:00:00"), due),
    ]
    t = {"collections": make(schema, rows), "credits": make("credit_id int, lending_partner_id string", [(1, "Alpha")])}
    # 20 hours late counts in the second and in the third bucket; no deadline is due at its last update.
    assert _board(sla.repayment_arm(t, NOW)) == {("Alpha", "REPAYMENTS"): (1, 0, 1, 1, 0, 0, 0, 0, 0)}


def test_lien_removal_unknown_lender_has_no_backlog_row(make):
    rows = [
        (1, 1, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-02 00:00:00")),
        (2, 2, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-02 00:00:00")),
        (3, 3, "REQUESTED", at("2024-03-01 00:00:00"), at("2024-03-09 00:00:00")),
    ]
    t = {
        "revocation_requests": make(REQUESTS, rows),
        "credit_main": make("credit_id int, lending_partner_id string", [(1, "Alpha"), (3, "Gamma")]),
    }
    assert _board(sla.lien_removal_arm(t, TERMS, NOW)) == {
        ("Alpha", "LIEN REMOVAL"): (0, 0, 0, 0, 0, 0, 0, 0, 1),
        ("Gamma", "LIEN REMOVAL"): (0, 0, 0, 0, 0, 0, 1, 0, 0),
    }


def test_credit_arms_share_one_pass_over_the_history(credits):
    out = sla.credit_arms(credits, TERMS, NOW)
    board = _board(out)
    assert board[("Alpha", "ACCOUNT OPENING")] == (0, 0, 0, 0, 0, 0, 1, 0, 0)
    assert board[("Beta", "LODGEMENT")] == (0, 0, 0, 0, 1, 0, 0, 0, 0)
    assert board[("Beta", "ACCOUNT OPENING")] == (0, 1, 0, 0, 1, 0, 0, 0, 0)


def test_display_names_and_order(credits, make, tmp_path):
    items = "credit_id int, created_on ts, last_updated_on ts"
    t = dict(credits) | {
        "enhance_limit_request": make(REQUESTS, []),
        "collections": make(items + ", collection_status string, settlement_expected_by ts", []),
        "disbursals": make("credit_id int, requested_on ts, last_updated_on ts, disbursal_status string, expected_transfer_by ts", []),
        "foreclosure_requests": make(REQUESTS + ", lender_id string", []),
        "revocation_requests": make(REQUESTS, []),
        "credits": make("credit_id int, lending_partner_id string", []),
    }
    board = sla.scoreboard(t, TERMS, NOW, display=True)
    assert board.columns[0] == "Request Type" and board.columns[-1] == "Lender" and len(board.columns) == 11
    assert board.count() == 6
    published = sla.published_reports(t, TERMS, NOW)
    assert len(published) == 8 and published["Data Lodgement"].agg(F.sum("count")).first()[0] == 7
    sinks.publish_all(published, str(tmp_path), orders={"Aggregate sheet Overall Data": ["Lender", "Request Type"]})
    back = board.sparkSession.read.parquet(str(tmp_path / "aggregate_sheet_overall_data"))
    assert back.count() == 6 and "5d_plus_unresolved_sla_breached" in back.columns
    assert len(list(tmp_path.iterdir())) == 8


def test_lookback_reaches_both_scans_below_the_joins(spark, credits, make, tmp_path):
    make(REQUESTS, []).write.parquet(str(tmp_path / "r"))
    credits["credit_main"].write.parquet(str(tmp_path / "m"))
    credits["credit_audit"].write.parquet(str(tmp_path / "a"))
    t = {
        "revocation_requests": spark.read.parquet(str(tmp_path / "r")),
        "credit_main": spark.read.parquet(str(tmp_path / "m")),
        "credit_audit": spark.read.parquet(str(tmp_path / "a")),
    }
    for frame in (sla.lien_removals(t, TERMS, NOW), sla.lodgements(t, TERMS, NOW)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(created_on,2024-01-30T00:00)" in plan
    assert "In(credit_status, [ACTIVE,APPROVED_NOT_DISBURSED,PENDING_CLOSURE" in plan
    # the history loses all other credits before it is summed
    assert plan.rindex("LeftSemi") > plan.index("HashAggregate") and plan.index("partial_min") < plan.index("LeftSemi")
