from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.plans import journey as J
from tests.conftest import at, rows_of

PLATFORMS = J.Platforms(house_ids=(1,), house_name="HOME", classes={"Direct": ["HOME"], "Software": ["SOFT"]})
APPLICATION = (
    "application_id int, account_id int, current_step_id string, application_state string, application_type string, "
    "last_updated_on ts, completed_on ts, created_on ts, platform_account_id int, partner_account_id int"
)
T = "2024-01-{:02d} 00:00:00".format


@pytest.fixture(scope="module")
def tables(make):
    leads = [
        (1, "PA", "9876543210", 2, 7),
        (2, "PA", "9876543210", 1, None),
        (3, "PB", "123", 1, None),
        (4, "PC", "9876543211", None, 7),
        (5, None, "9876543212", 1, None),
        (6, "PD", "9876543213", 1, None),
        (7, "PD", "9876543213", 1, None),
    ]
    portfolio = [
        (1, 100.0, 50.0, 26000.0, at(T(1)), at(T(5))),
        (2, 200.0, 60.0, 40000.0, at(T(2)), at(T(5))),
        (2, 300.0, 70.0, 90000.0, at(T(3)), at(T(4))),
        (3, 400.0, 80.0, 24999.99, at(T(1)), at(T(5))),
        (5, 500.0, 90.0, 99000.0, at(T(1)), at(T(5))),
        (6, 600.0, 95.0, 25000.0, at(T(1)), None),
    ]
    applications = [
        (11, 21, None, "COMPLETED", C.BORROWER_TYPE, at(T(9)), None, at(T(3)), 2, 7),
        (12, 22, "X", "IN_PROGRESS", C.BORROWER_TYPE, at(T(8)), None, None, None, None),
        (13, 22, "X", "SUSPENDED", C.BORROWER_TYPE, at(T(8)), None, None, None, None),
        (14, 22, "X", "IN_PROGRESS", C.RENEWAL_TYPE, at(T(8)), None, None, None, None),
        (15, 23, "X", None, C.BORROWER_TYPE, at(T(8)), None, None, None, None),
    ]
    limits = [
        (11, 10.0, 5.0, 30000.0, 2.0, 1111.0, at(T(1))),
        (12, 10.0, 5.0, 31000.0, 0.0, 2222.0, at(T(2))),
        (14, 10.0, 5.0, 31000.0, 0.0, 2222.0, at(T(2))),
    ]
    audit = [
        (11, 21, C.FETCH_STEP, "IN_PROGRESS", C.BORROWER_TYPE, at(T(1)), None, at(T(1)), 2, 7),
        (11, 21, C.FETCH_STEP, "IN_PROGRESS", C.BORROWER_TYPE, at(T(2)), None, at(T(2)), 2, 7),
        (11, 21, C.PLEDGE_STEP, "IN_PROGRESS", C.BORROWER_TYPE, at(T(3)), None, at(T(3)), 2, 7),
    ]
    return {
        "customer_leads": make("lead_id int, pan string, phone_number string, platform_account_id int, partner_account_id int", leads),
        "leads_portfolio_data": make(
            "lead_id int, total_portfolio_value double, eligible_portfolio_value double, eligible_credit_limit double, created_on ts, last_updated_on ts",
            portfolio,
        ),
        "credit_applications_entity": make(APPLICATION, applications),
        "credit_applications_entity_audit": make(APPLICATION, audit),
        "credit_application_meta_data": make(
            "application_id int, available_portfolio_value double, eligible_portfolio_value double, eligible_credit_limit double, "
            "pledged_portfolio_value double, pledged_credit_limit double, created_on ts",
            limits,
        ),
        "borrower_accounts": make(
            "account_id int, account_holderpan string, account_holder_phone_number string", [(21, "PA", None), (22, "PX", "0123"), (23, None, None)]
        ),
        "partner_accounts": make("account_id int, partner_name string, partner_account_type string", [(7, "P7", "INDIVIDUAL")]),
        "platform_accounts": make("account_id int, platform_name string", [(1, "HOME"), (2, "SOFT")]),
    }


@pytest.mark.parametrize("hot_parts", [1, 10**6])
def test_journey(tables, hot_parts):
    out = J.journey_of(tables, PLATFORMS, hot_parts=hot_parts)
    assert out.columns == [*J.JOURNEY_COLUMNS, "eligible", "platform_type", "sanctioned_limit"]
    shown = out.select(
        "pan", "application_id", "platform_name", "application_stage", "eligible_credit_limit_temp", "created_on",
        "completed_on", "mfc_total_portfolio_value", "phone_number", "platform_type", "sanctioned_limit",
    )
    assert rows_of(shown) == sorted(
        [
            # both tied latest lead rows of PA meet the application; its date is the earlier of both sides,
            # and a completed application without a date gets its last update
            ("PA", 11, "SOFT", "Completed", 30000.0, at(T(1)), at(T(9)), 100.0, "9876543210", "Software", 1111.0),
            ("PA", 11, "SOFT", "Completed", 30000.0, at(T(2)), at(T(9)), 200.0, "9876543210", "Software", 1111.0),
            # application only: default platform, unusable phone
            ("PX", 12, "HOME", "Post Fetch", 31000.0, at(T(2)), None, 0.0, None, "Direct", 2222.0),
            # lead only, all times missing: the row with the portfolio is eligible, the bare lead is not
            ("PD", None, "HOME", "MFC Fetch", 25000.0, at(T(1)), None, 600.0, "9876543213", "Direct", None),
        ],
        key=repr,
    )


def test_persons_without_portfolio_and_null_persons_have_no_lead_side(tables):
    leads, portfolio = J.customer_leads(tables, PLATFORMS), J.portfolio_leads(tables)
    best = J.person_extremes(leads, portfolio, "last_updated_on", "max")
    latest = J.leads_at(leads, portfolio, best, "last_updated_on")
    assert rows_of(latest.select("lead_id", "mfc_total_portfolio_value")) == [(1, 100.0), (2, 200.0), (3, 400.0), (6, 600.0), (7, None)]


def test_channels_of_leads(tables):
    got = dict(rows_of(J.customer_leads(tables, PLATFORMS).select("lead_id", "business_channel")))
    assert got == {1: "B2B", 2: "B2C", 3: "B2C", 4: "B2B2C", 5: "B2C", 6: "B2C", 7: "B2C"}


def test_stage_facts_take_the_latest_row(tables):
    facts = J.application_facts(tables, PLATFORMS, C.FETCH_STEP)
    assert rows_of(facts.select("application_id", "created_on", "app_eligible_credit_limit")) == [(11, at(T(2)), 30000.0)]
    assert J.application_facts(tables, PLATFORMS, C.PLEDGE_STEP).count() == 1


def _journey(make, rows):
    schema = (
        "completed_on ts, created_on ts, platform_name string, platform_type string, app_current_step_id string, "
        "application_state string, eligible_credit_limit_temp decimal(18,2), sanctioned_limit decimal(18,2)"
    )
    fixed = [(*r[:6], Decimal(r[6]), None if r[7] is None else Decimal(r[7])) for r in rows]
    return make(schema, fixed)


def test_rollups(make):
    done = (None, "COMPLETED")
    frame = _journey(
        make,
        [
            (at("2024-01-05 00:00:00"), at("2024-01-01 00:00:00"), "A", "T", *done, "10", "1"),
            (at("2024-01-06 00:00:00"), at("2024-01-01 00:00:00"), "A", "T", *done, "30", None),
            (at("2024-01-07 00:00:00"), None, "B", "T", *done, "50", None),
            (at("2024-02-07 00:00:00"), None, None, "T", *done, "50", "4"),
            (None, at("2024-02-01 00:00:00"), "A", "T", *done, "50", "4"),
            (at("2024-01-05 00:00:00"), at("2024-01-01 00:00:00"), "A", "T", "STEP", "COMPLETED", "70", "1"),
        ],
    )

    def plain(out):
        return [tuple(float(x) if i > 1 else x for i, x in enumerate(r)) for r in rows_of(out)]

    assert plain(J.completed_by_platform(frame, "M", "2024-01-21")) == [("2024-01", "A", 2, 1, 20, 20), ("2024-01", "B", 1, 0, 50, 50)]
    # by day only the last 15 days, to the instant
    assert plain(J.completed_by_platform(frame, "D", "2024-01-21 00:00:00")) == [
        ("2024-01-06", "A", 1, 0, 30, 30),
        ("2024-01-07", "B", 1, 0, 50, 50),
    ] + plain(J.completed_by_platform(frame, "D", "2024-02-20"))
    both = plain(J.platform_and_type(J.completed_rows(frame, "M", "2024-01-21"), "completed_on", "M", "completed_month"))
    assert both == sorted(
        [
            ("2024-01", "A", 2, 1, 20, 20),
            ("2024-01", "B", 1, 0, 50, 50),
            ("2024-01", "T", 3, 1, 30, 30),
            ("2024-02", "T", 1, 4, 50, 50),
        ],
        key=repr,
    )
    assert plain(J.registered_by_platform(frame, "M")) == [("2024-01", "A", 3, 2, 110 / 3, 30), ("2024-02", "A", 1, 4, 50, 50)]
    generic = J.completed_by(frame, "completed_on", "platform_type", "M")
    assert plain(generic) == [("2024-01", "T", 3, 1, 30, 30, 90), ("2024-02", "T", 1, 1, 50, 50, 50)]


def test_published_titles(tables):
    published = J.published_rollups(tables, PLATFORMS, "2024-02-01")
    assert tuple(published) == J.PUBLISHED
    # Two rows of PA and the lead of PD, each under its platform and under its platform type.
    assert published["grouped fetched on"].agg(F.sum("count")).first()[0] == 6
