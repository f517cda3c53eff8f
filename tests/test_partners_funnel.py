from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.plans import funnel, journey, partners
from tests.conftest import at, rows_of

START = "2023-05-05 00:00:00"
AS_OF = "2024-03-10 12:00:00"
ENTITY = (
    "lender_account_id int, application_id int, account_id int, partner_account_id int, platform_account_id int, "
    "application_type string, current_step_id string, application_state string, last_updated_on ts, created_on ts, completed_on ts"
)
T = "2023-{:02d}-{:02d} 00:00:00".format


def _application(id_, state, updated, completed=None, type_=C.BORROWER_TYPE, account=50, created=None, partner=7):
    return (1, id_, account, partner, 2, type_, None, state, updated and at(updated), created and at(created), completed and at(completed))


@pytest.fixture(scope="module")
def tables(make):
    applications = [
        _application(1, "COMPLETED", T(6, 1), T(5, 20)),
        _application(2, "COMPLETED", T(6, 1)),
        _application(3, "SUSPENDED", T(6, 1)),
        _application(4, "SUSPENDED", T(6, 1)),
        _application(5, "COMPLETED", T(4, 1), type_=C.RENEWAL_TYPE),
        _application(6, "COMPLETED", T(4, 1), account=51, created=T(1, 1)),
        _application(7, "COMPLETED", T(4, 1), account=51, created=T(1, 1)),
        _application(8, "IN_PROGRESS", T(6, 1)),
        _application(9, "COMPLETED", T(6, 1), partner=None),
    ]
    audit = [
        (2, "IN_PROGRESS", at(T(5, 10))),
        (2, "COMPLETED", at(T(5, 9))),
        (2, "IN_PROGRESS", at(T(5, 11))),
        (2, "COMPLETED", at(T(5, 12))),
        (2, "COMPLETED", at(T(5, 13))),
        (3, "COMPLETED", at(T(5, 14))),
        (8, "COMPLETED", at(T(5, 14))),
    ]
    return {
        "credit_applications_entity": make(ENTITY, applications),
        "credit_applications_entity_audit": make("application_id int, application_state string, last_updated_on ts", audit),
        "credit_main": make("account_id int, created_on ts", [(51, at(T(2, 1))), (51, at(T(3, 1))), (50, at(T(7, 1)))]),
        "credit_application_meta_data": make(
            "application_id int, eligible_credit_limit decimal(18,2), pledged_credit_limit decimal(18,2)",
            [(i, Decimal(10), Decimal(100 + i)) for i in range(1, 10)],
        ),
        "partner_accounts": make("account_id int, partner_account_type string", [(7, "INDIVIDUAL")]),
        "platform_accounts": make("account_id int, platform_name string", [(2, "SOFT")]),
    }


@pytest.mark.parametrize("hot_parts", [1, 10**6])
def test_effective_applications_fan_out_by_history(tables, hot_parts):
    rows = partners.effective_applications(tables, hot_parts=hot_parts)
    got = rows_of(rows.groupBy("application_id", "application_state").count())
    assert got == sorted(
        [(1, "COMPLETED", 1), (2, "COMPLETED", 3), (3, "COMPLETED", 1), (4, "SUSPENDED", 1)]
        + [(i, "COMPLETED", 1) for i in (5, 6, 7, 9)]
    )
    assert partners.effective_applications(tables, dedupe_history=True).count() == 8


def test_completion_dates_from_four_sources(tables):
    got = partners.completion_dates(tables, START, exclude_ids=(7,))
    assert rows_of(got) == [
        (1, at(T(5, 20)), partners.OWN_DATE),
        (2, at(T(5, 12)), partners.FROM_HISTORY),
        (5, at(T(4, 1)), partners.BEFORE_HISTORY),
        (6, at(T(2, 1)), partners.FIRST_CREDIT),
    ]


def test_weighted_credits_give_the_figures_of_the_copied_rows(tables):
    for as_of in ("2023-06-20", "2023-07-20", AS_OF):
        copied = partners.completed_credits(tables, START)
        weighted = partners.completed_credits(tables, START, expand=False)
        for report in (partners.partner_history, partners.partner_last_month):
            assert rows_of(report(copied, as_of)) == rows_of(report(weighted, as_of))
    once = partners.completed_credits(tables, START, dedupe_history=True)
    assert copied.count() == once.count() + 2
    assert weighted.agg(F.sum("copies")).first()[0] == copied.count()


def _credits(make, rows):
    schema = "partner_account_id int, application_id int, application_type string, pledged_credit_limit decimal(18,2), current_step_started_on ts"
    return make(schema, [(p, a, t, Decimal(m), at(x)) for p, a, t, m, x in rows])


def test_partner_classes(make):
    new = C.BORROWER_TYPE
    rows = [(1, i, new, 2500000, f"2023-11-{i:02d} 00:00:00") for i in range(1, 6)]
    # gold needs more than one and a half customers per month: five over four months are too few
    rows += [(2, i, new, 2500000, f"2023-09-{i:02d} 00:00:00") for i in range(1, 6)]
    # activated in the month two months back: no months, so never gold, and recent
    rows += [(3, i, new, 2500000, f"2024-01-{i:02d} 00:00:00") for i in range(1, 6)]
    rows += [(4, 1, new, 100, "2023-12-16 00:00:00"), (5, 1, new, 100, "2023-12-15 00:00:00"), (6, 1, new, 100, "2024-02-01 00:00:00")]
    history = partners.partner_history(_credits(make, rows), AS_OF)
    out = partners.partner_classes(history, AS_OF)
    got = {r["partner_account_id"]: r for r in out.collect()}
    # reference day: 1 March less 31 days = 30 January
    assert {k: (r["month_count"], r["mfd_group_1"], r["mfd_group_2"]) for k, r in got.items()} == {
        1: (2, "GOLD", "CHURN"),
        2: (4, "REST", "CHURN"),
        3: (0, "Activations < 45 days", "ACTIVE"),
        4: (1, "REST", "ACTIVE"),
        5: (1, "REST", "CHURN"),
    }
    assert got[1]["average_customer_per_month"] == 2.5 and got[3]["average_customer_per_month"] is None
    assert got[1]["days_diff"] == 120
    assert len(out.columns) == 13 and len(history.columns) == 9


def test_scorecard(make):
    new, renewal = C.BORROWER_TYPE, C.RENEWAL_TYPE
    rows = [
        (1, 1, new, 100, "2023-12-01 00:00:00"),
        (1, 2, new, 200, "2024-02-10 00:00:00"),
        (1, 2, new, 200, "2024-02-11 00:00:00"),
        (1, 3, renewal, 300, "2024-02-12 00:00:00"),
        (2, 4, "OTHER", 400, "2024-02-29 23:59:59"),
        (3, 5, new, 500, "2024-01-31 23:59:59"),
        (4, 6, new, 500, "2024-03-01 00:00:00"),
    ]
    credits = _credits(make, rows)
    out = partners.scorecard(partners.partner_periods(credits, AS_OF), AS_OF)
    assert len(out.columns) == 17
    shown = out.select(
        "partner_account_id", "mfd_group_1", "case_done_flag", "current_applications", "current_new_applications",
        "current_renewal_applications", "current_existing_applications", "current_sum_pledged_credit_limit", "prev_total_customers",
    )
    assert rows_of(shown) == [
        (1, "REST", "case done", 2, 1, 1, 1, Decimal("700.00"), 1),
        (2, "New MFD", "case done", 1, 0, 0, 1, Decimal("400.00"), None),
        (3, "Activations < 45 days", "case not done", None, None, None, None, None, 1),
    ]


def test_payout_check(make):
    day = at("2024-01-01 20:00:00")
    t = {
        "payout_transactions": make(
            "destination_id int, payment_date date, credit_account_number string",
            [(1, date(2024, 1, 3), "x"), (1, date(2024, 1, 1), "x"), (1, date(2024, 1, 2), "y"), (9, date(2024, 1, 2), "z"), (2, None, "q")],
        ),
        "credit_main": make("partner_account_id int, created_on ts", [(1, day), (None, day)]),
        "partner_accounts": make(
            "account_id int, partner_name string, bank_account_number string, bank_accountifsccode string",
            [(1, "One", "  12 ", "I"), (2, "Two", " ", "J"), (3, "Three", None, "K")],
        ),
    }
    for hot_parts in (1, 10**6):
        out = partners.partner_payout_check(t, hot_parts=hot_parts)
        # the first credit at 20:00 UTC is the next business day
        assert rows_of(out) == sorted(
            [
                (1, "x", date(2024, 1, 1), date(2024, 1, 3), "One", "[12]", "I", date(2024, 1, 2), "activated"),
                (1, "y", date(2024, 1, 2), date(2024, 1, 2), "One", "[12]", "I", date(2024, 1, 2), "activated"),
                (9, "z", date(2024, 1, 2), date(2024, 1, 2), None, None, None, None, None),
                (2, None, None, None, "Two", "", "J", None, "empanelled"),
                (3, None, None, None, "Three", None, "K", None, "empanelled"),
            ],
            key=repr,
        )


@pytest.fixture(scope="module")
def funnel_tables(make):
    day = "2024-05-{:02d} 20:00:00".format
    leads = [
        (1, "PA", "9", 4, 7, at(day(2)), "Lead A", "a@x", "R1"),
        (2, "PA", "9", 4, 7, at(day(3)), "Lead A2", "a@x", "R2"),
        (3, "PB", "8", 4, None, None, "Lead B", None, "R3"),
        (4, "PC", "7", 5, None, at(day(1)), "Lead C", "c@x", "R4"),
        (5, "PE", "7", 4, None, at("2024-04-01 00:00:00"), "Lead E", "e@x", "R5"),
    ]
    applications = [
        (1, 11, 21, 7, 4, C.BORROWER_TYPE, None, "COMPLETED", at(day(9)), at(day(1)), at(day(8))),
        (1, 12, 21, 7, 5, C.BORROWER_TYPE, "S", "IN_PROGRESS", at(day(9)), at(day(4)), None),
        (1, 13, 22, 7, 5, C.BORROWER_TYPE, "S", "IN_PROGRESS", at(day(9)), at(day(4)), None),
        (1, 14, 21, 7, 4, C.RENEWAL_TYPE, "S", "IN_PROGRESS", at(day(9)), at("2020-01-01 00:00:00"), None),
        (1, 15, 23, 7, 4, C.BORROWER_TYPE, "S", "IN_PROGRESS", at(day(9)), at(day(4)), None),
    ]
    return {
        "customer_leads": make(
            "lead_id int, pan string, phone_number string, platform_account_id int, partner_account_id int, created_date_time ts, "
            "full_name string, email_id string, request_id string",
            leads,
        ),
        "leads_portfolio_data": make(
            "lead_id int, total_portfolio_value int, eligible_portfolio_value int, eligible_credit_limit int, created_on ts, last_updated_on ts",
            [(1, 1, 1, 100, at(day(2)), None), (2, 1, 1, 200, at(day(3)), None), (3, 1, 1, 300, None, None), (4, 1, 1, 400, at(day(1)), None), (5, 1, 1, 1, at(day(1)), None)],
        ),
        "credit_applications_entity": make(ENTITY, applications),
        "credit_application_meta_data": make(
            "application_id int, available_portfolio_value int, eligible_portfolio_value int, eligible_credit_limit int, "
            "pledged_portfolio_value int, pledged_credit_limit int, created_on ts",
            [(11, 1, 2, 3, 4, 5, None)],
        ),
        "borrower_accounts": make(
            "account_id int, account_holder_name string, account_holderpan string, account_holder_phone_number string, account_holder_email string",
            [(21, "Holder A", "PA", "99", "h@x"), (22, "Holder D", "PD", "98", "d@x"), (23, "No pan", None, "97", None)],
        ),
        "partner_accounts": make("account_id int, partner_name string, partner_account_type string", [(7, "P7", "INDIVIDUAL")]),
        "platform_accounts": make("account_id int, platform_name string", [(4, "FOUR"), (5, "FIVE")]),
        "asset_fetch_data": make("application_id int, asset_repository string", [(11, "CAMS"), (11, "OTHER"), (12, "KARVY")]),
        "asset_pledge_data": make("application_id int, isin_no string", [(11, "I1"), (11, "I2"), (11, None)]),
        "communication_message_records": make(
            "message_type string, primary_recipient string, status string, record_created_on ts, record_last_updated_on ts",
            [
                ("EMAIL", "a@x", "SENT", at(day(1)), at(day(1))),
                ("EMAIL", "a@x", "READ", at(day(1)), at(day(2))),
                ("SMS", "a@x", "LATER", at(day(1)), at(day(9))),
                ("EMAIL", None, "SENT", at(day(1)), at(day(9))),
            ],
        ),
    }


@pytest.mark.parametrize("hot_parts", [1, 10**6])
def test_platform_lead_funnel(funnel_tables, hot_parts):
    portfolio = journey.portfolio_leads(funnel_tables)
    out = funnel.platform_lead_funnel(funnel_tables, portfolio, 4, "2024-05-01", hot_parts=hot_parts)
    assert tuple(out.columns) == funnel.FUNNEL_COLUMNS
    shown = out.select(
        "account_holderpan", "application_id", "created_on", "current_step_id", "completed_on", "cams_fetched", "karvy_fetched",
        "mfc_eligible_credit_limit", "mf_count", "email_address", "email_status", "platform_name", "account_holder_phone_number",
    )
    # 20:00 UTC is the next day in business time. PA's first application is a day before its lead: it counts
    # only on the same platform. PB has neither date nor application, PE and PC are outside, PD is another platform.
    assert rows_of(shown) == [
        ("PA", 11, date(2024, 5, 2), "COMPLETED", date(2024, 5, 9), "Y", "N", 100, 2, "a@x", "READ", "FOUR", "99"),
        ("PA", 12, date(2024, 5, 3), "S", None, "N", "Y", 100, None, "a@x", "READ", "FIVE", "99"),
    ]


def test_lead_without_application_shows_the_fetched_step(funnel_tables):
    portfolio = journey.portfolio_leads(funnel_tables)
    early = funnel.platform_lead_funnel(funnel_tables, portfolio, 4, "2024-04-01")
    row = early.filter("account_holderpan = 'PE'").first()
    assert (row["current_step_id"], row["created_on"], row["platform_name"]) == (funnel.FETCHED_ONLY, date(2024, 4, 1), "FOUR")


def test_application_funnel(funnel_tables):
    rows = funnel.application_funnel(funnel_tables).select("application_id", "app_created_on", "current_step_id", "platform_name")
    assert rows_of(rows) == [
        (11, at("2024-05-01 20:00:00"), "COMPLETED", "FOUR"),
        (12, at("2024-05-01 20:00:00"), "S", "FIVE"),
        (13, at("2024-05-04 20:00:00"), "S", "FIVE"),
    ]
