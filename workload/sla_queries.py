"""Service-level cubes and scoreboard on the stand-ins."""

from __future__ import annotations

from datetime import timedelta

from loanops.plans import sla
from workload.registry import query
from workload.standins import AS_OF

# Wide enough that every stand-in row is inside.
ALL_DAYS = 4000
TERMS = sla.LenderTerms(
    lien_removal={"Beta": timedelta(days=7), "Alpha": timedelta(days=5)},
    foreclosure={"Beta": timedelta(days=5), "Alpha": timedelta(days=7)},
    opening={"Alpha": timedelta(minutes=30), "Beta": timedelta(hours=4)},
    lodged={"Alpha": timedelta(minutes=15), "Beta": timedelta(hours=2)},
    unlodged={"Alpha": timedelta(minutes=30), "Beta": timedelta(hours=4)},
)
NOW = f"timestamp '{AS_OF}'"


def _bucket(gap: str, first: str, second: str) -> str:
    return f"case when {gap} <= interval '{first}' then 'L1' when {gap} <= interval '{second}' then 'L2' else 'L3' end"


def _request_cube(source, start, deadline, status, done, failed, waiting, first, second, date_name, verdict_name, own=""):
    end = "last_updated_on"
    return f"""
      select request_day as {date_name}, verdict as {verdict_name}, time_delay_till_today, delay_in_settlement,
             count(*) as count
      from (
        select cast({start} as date) as request_day,
               case when {status} in ({done}) and epoch_us({end}) - epoch_us({start}) > epoch_us({deadline}) - epoch_us({start}) then 'NO'
                    when {waiting} and {NOW} > {deadline} and {start} is not null then 'NOT SETTLED SLA BREACHED'
                    when {waiting} and {NOW} <= {deadline} and {start} is not null then 'NOT SETTLED NO SLA BREACHED'
                    when {status} in ({failed}) then 'FAILED' {own}
                    else 'YES' end as verdict,
               case when {status} in ({done}) then null else {_bucket(f'{NOW} - {end}', first, second)} end
                 as time_delay_till_today,
               case when {status} in ({done}) and {end} > {deadline} then {_bucket(f'{end} - {deadline}', first, second)} end
                 as delay_in_settlement
        from ({source}) where {start} >= {NOW} - interval '{ALL_DAYS} days'
      ) group by all"""


def _credit_items() -> str:
    return """
      select m.*, opened_on, lodged_on,
             created_on + case lending_partner_id when 'Alpha' then interval '30 minutes'
                               when 'Beta' then interval '4 hours' end as opening_deadline,
             case when lending_partner_id = 'Alpha' and lodged_on is not null then lodged_on + interval '15 minutes'
                  when lending_partner_id = 'Beta' and lodged_on is not null then lodged_on + interval '2 hours'
                  when lending_partner_id = 'Alpha' then coalesce(opened_on, created_on) + interval '30 minutes'
                  when lending_partner_id = 'Beta' then coalesce(opened_on, created_on) + interval '4 hours'
             end as lodgement_deadline
      from credit_main m
      left join (select credit_id, min(last_updated_on) as opened_on from credit_audit
                 where credit_status in ('PENDING_LODGEMENT', 'APPROVED_NOT_DISBURSED', 'ACTIVE', 'PENDING_CLOSURE')
                 group by credit_id) o using (credit_id)
      left join (select credit_id, min(last_updated_on) as lodged_on from credit_audit
                 where credit_status in ('APPROVED_NOT_DISBURSED', 'ACTIVE', 'PENDING_CLOSURE')
                 group by credit_id) l using (credit_id)"""


def _credit_cube(start, end, deadline, settled, open_, unlate, pending, date_name):
    return f"""
      select cast(created_on as date) as {date_name},
             case when {deadline} >= {end} then 'YES'
                  when credit_status in ({settled}) and {end} is null then 'YES'
                  when {end} > {deadline} then 'NO'
                  when {end} is null and {deadline} > {NOW} {pending} then 'NOT SETTLED NO SLA BREACHED'
                  when {end} is null and {NOW} > {deadline} then 'NOT SETTLED SLA BREACHED'
                  else 'DONT KNOW' end as settled_under_time,
             case when credit_status not in ({open_}) then null
                  else {_bucket(f'{NOW} - {end}', '120 minutes', '3600 minutes')} end as time_delay_till_today,
             case when credit_status not in ({unlate}) and {end} > {deadline} and {start} is not null
                  then {_bucket(f'{end} - {deadline}', '120 minutes', '3600 minutes')} end as delay_in_settlement,
             count(*) as count
      from ({_credit_items()}) where created_on >= {NOW} - interval '{ALL_DAYS} days'
      group by all"""


def _board(source, channel, end, deadline, done, waiting, l1, l2, l3, aged, backlog_filter="true", done_filter="true"):
    return f"""
      select coalesce(s.update_date, w.update_date) as update_date, coalesce(s.lender, w.lender) as lender_id,
             '{channel}' as channel_type,
             coalesce(s.within_sla, 0) as success_within_sla, coalesce(s.l1, 0) as success_l1,
             coalesce(s.l2, 0) as success_l2, coalesce(s.l3, 0) as success_l3,
             coalesce(w.within_sla, 0) as non_success_within_sla, coalesce(w.l1, 0) as non_success_l1,
             coalesce(w.l2, 0) as non_success_l2, coalesce(w.l3, 0) as non_success_l3,
             coalesce(w.l4, 0) as non_success_l4
      from (
        select date_trunc('day', {end}) as update_date, lender,
               count(*) filter ({done} and {end} <= {deadline}) as within_sla,
               count(*) filter ({done} and {end} > {deadline} and {end} - {deadline} <= interval '{l1}') as l1,
               count(*) filter ({done} and {end} > {deadline} and {end} - {deadline} > interval '{l1}'
                                and {end} - {deadline} <= interval '{l2}') as l2,
               count(*) filter ({done} and {end} > {deadline} and {end} - {deadline} > interval '{l3}') as l3
        from ({source}) where date_trunc('day', {end}) = date_trunc('day', {NOW}) and {done_filter} group by all) s
      full join (
        select date_trunc('day', {NOW}) as update_date, lender,
               count(*) filter ({waiting} and {NOW} <= {deadline}) as within_sla,
               count(*) filter ({waiting} and {NOW} > {deadline} and {NOW} - {aged} <= interval '1 day') as l1,
               count(*) filter ({waiting} and {NOW} > {deadline} and {NOW} - {aged} > interval '1 day'
                                and {NOW} - {aged} <= interval '3 days') as l2,
               count(*) filter ({waiting} and {NOW} > {deadline} and {NOW} - {aged} > interval '3 days'
                                and {NOW} - {aged} <= interval '5 days') as l3,
               count(*) filter ({waiting} and {NOW} > {deadline} and {NOW} - {aged} > interval '5 days') as l4
        from ({source}) where {backlog_filter} group by lender) w
      on s.update_date = w.update_date and s.lender = w.lender"""


_ENHANCE = "select *, created_on + interval '2 hours' as deadline from enhance_limit_request"
_REVOKE = """select r.*, lending_partner_id as lender,
    r.created_on + case lending_partner_id when 'Beta' then interval '7 days' when 'Alpha' then interval '5 days' end as deadline
    from revocation_requests r left join credit_main m on r.credit_id = m.credit_id"""
_FORECLOSE = """select *, created_on + case lender_id when 'Beta' then interval '5 days' when 'Alpha' then interval '7 days' end
    as deadline from foreclosure_requests"""
_NOT_DONE = "status <> 'SUCCESS'"

CUBES = {
    "j01_withdrawals": _request_cube(
        "select * from disbursals", "requested_on", "expected_transfer_by", "disbursal_status", "'SETTLED'",
        "'REJECTED', 'FAILED'", "disbursal_status not in ('SETTLED', 'REJECTED', 'FAILED')", "2 hours", "6 hours",
        "requested_date", "settled_under_time"),
    "j02_repayments": _request_cube(
        "select * from collections", "created_on", "settlement_expected_by", "collection_status", "'SETTLED'",
        "'CANCELLED', 'FAILED'", "collection_status not in ('REQUESTED', 'SETTLED', 'CANCELLED', 'FAILED')",
        "2 hours", "6 hours", "requested_date", "success_under_time",
        "when collection_status = 'REQUESTED' then 'REQUESTED'"),
    "j03_lien_removal": _request_cube(
        _REVOKE, "created_on", "deadline", "status", "'SUCCESS'", "'FAILED'", "status not in ('SUCCESS', 'FAILED')",
        "1 day", "3 days", "requested_date", "success_under_time"),
    "j04_foreclosure": _request_cube(
        f"select distinct * from ({_FORECLOSE}) where lender_id in ('Alpha', 'Beta')", "created_on", "deadline", "status",
        "'SUCCESS'", "'FAILED'", "status not in ('SUCCESS', 'FAILED')", "1 day", "3 days", "requested_date",
        "success_under_time"),
    "j05_account_opening": _credit_cube(
        "created_on", "opened_on", "opening_deadline", "'ACTIVE'", "'PENDING_DISBURSAL_APPROVAL'",
        "'PENDING_DISBURSAL_APPROVAL'", "", "credit_created_on_date"),
    "j06_lodgement": _credit_cube(
        "opened_on", "lodged_on", "lodgement_deadline", "'ACTIVE', 'PENDING_CLOSURE', 'CLOSED'",
        "'PENDING_DISBURSAL_APPROVAL', 'PENDING_LODGEMENT'",
        "'PENDING_DISBURSAL_APPROVAL', 'PENDING_LODGEMENT', 'APPROVED_NOT_DISBURSED'",
        "and credit_status in ('PENDING_DISBURSAL_APPROVAL', 'PENDING_LODGEMENT')", "credit_created_on"),
    "j07_enhancement": _request_cube(
        _ENHANCE, "created_on", "deadline", "status", "'SUCCESS'", "'FAILED'", "status = 'REQUESTED'", "2 hours",
        "6 hours", "created_on_date", "settled_under_time"),
}

BOARDS = {
    "j08_board_enhancement": _board(
        f"select e.*, lending_partner_id as lender from ({_ENHANCE}) e left join credits c on e.credit_id = c.credit_id",
        "ENHANCEMENTS", "last_updated_on", "deadline", "status = 'SUCCESS'", _NOT_DONE, "2 hours", "6 hours", "6 hours",
        "last_updated_on"),
    "j09_board_repayment": _board(
        """select l.*, coalesce(settlement_expected_by, last_updated_on) as deadline, lending_partner_id as lender
           from collections l left join credits c on l.credit_id = c.credit_id
           where collection_status not in ('FAILED', 'REQUESTED', 'CANCELLED')""",
        "REPAYMENTS", "last_updated_on", "deadline", "collection_status = 'SETTLED'", "collection_status <> 'SETTLED'",
        "2 hours", "36 hours", "6 hours", "last_updated_on"),
    "j10_board_withdrawal": _board(
        """select d.*, coalesce(expected_transfer_by, last_updated_on) as deadline, lending_partner_id as lender
           from disbursals d left join credits c on d.credit_id = c.credit_id
           where disbursal_status not in ('FAILED', 'REJECTED')""",
        "WITHDRAWALS", "last_updated_on", "deadline", "disbursal_status = 'SETTLED'", "disbursal_status <> 'SETTLED'",
        "2 hours", "6 hours", "6 hours", "last_updated_on"),
    "j11_board_foreclosure": _board(
        f"select *, lender_id as lender from ({_FORECLOSE}) where lender_id is not null",
        "FORECLOSURE", "last_updated_on", "deadline", "status = 'SUCCESS'", _NOT_DONE, "1 day", "3 days", "3 days",
        "last_updated_on"),
    "j12_board_lien_removal": _board(
        f"select * replace (case when lender in ('Alpha', 'Beta') then deadline else last_updated_on end as deadline) from ({_REVOKE})",
        "LIEN REMOVAL", "last_updated_on", "deadline", "status = 'SUCCESS'", _NOT_DONE, "1 day", "3 days", "3 days",
        "last_updated_on", backlog_filter="lender is not null"),
    "j13_board_opening": _board(
        f"select *, lending_partner_id as lender from ({_credit_items()})", "ACCOUNT OPENING", "opened_on",
        "opening_deadline", "credit_status in ('PENDING_LODGEMENT', 'APPROVED_NOT_DISBURSED', 'ACTIVE', 'PENDING_CLOSURE')",
        "credit_status = 'PENDING_DISBURSAL_APPROVAL'", "1 day", "3 days", "3 days", "opening_deadline"),
    "j14_board_lodgement": _board(
        f"select *, lending_partner_id as lender from ({_credit_items()})", "LODGEMENT", "lodged_on",
        "lodgement_deadline", "credit_status in ('ACTIVE', 'PENDING_CLOSURE', 'CLOSED')",
        "credit_status = 'PENDING_LODGEMENT'", "1 day", "3 days", "3 days", "lodgement_deadline"),
}
BOARDS["j15_scoreboard"] = (
    "select channel_type, success_within_sla, success_l1, success_l2, success_l3, non_success_within_sla, "
    "non_success_l1, non_success_l2, non_success_l3, non_success_l4, lender_id from ("
    + " union all ".join(f"({text})" for text in BOARDS.values())
    + ")"
)
ALL = {"lookback_days": ALL_DAYS}

# Inside the order dates, so that the published look-back of 40 days leaves most rows out.
RECENT_AS_OF = "1998-07-20 13:45:00"
RECENT_CUBES = {
    name: text.replace(f"{NOW} - interval '{ALL_DAYS} days'", f"cast(cast({NOW} as date) - 40 as timestamp)").replace(AS_OF, RECENT_AS_OF)
    for name, text in CUBES.items()
}


def _recent(name, cube):
    query(f"{name}_40_days", RECENT_CUBES[name])(cube)


_recent("j01_withdrawals", lambda t: sla.withdrawals(t, RECENT_AS_OF))
_recent("j02_repayments", lambda t: sla.repayments(t, RECENT_AS_OF))
_recent("j03_lien_removal", lambda t: sla.lien_removals(t, TERMS, RECENT_AS_OF))
_recent("j04_foreclosure", lambda t: sla.foreclosures(t, TERMS, RECENT_AS_OF))
_recent("j05_account_opening", lambda t: sla.account_openings(t, TERMS, RECENT_AS_OF))
_recent("j06_lodgement", lambda t: sla.lodgements(t, TERMS, RECENT_AS_OF))
_recent("j07_enhancement", lambda t: sla.enhancements(t, RECENT_AS_OF))


@query("j01_withdrawals", CUBES["j01_withdrawals"])
def _(t):
    return sla.withdrawals(t, AS_OF, **ALL)


@query("j02_repayments", CUBES["j02_repayments"])
def _(t):
    return sla.repayments(t, AS_OF, **ALL)


@query("j03_lien_removal", CUBES["j03_lien_removal"])
def _(t):
    return sla.lien_removals(t, TERMS, AS_OF, **ALL)


@query("j04_foreclosure", CUBES["j04_foreclosure"])
def _(t):
    return sla.foreclosures(t, TERMS, AS_OF, **ALL)


@query("j05_account_opening", CUBES["j05_account_opening"])
def _(t):
    return sla.account_openings(t, TERMS, AS_OF, **ALL)


@query("j06_lodgement", CUBES["j06_lodgement"])
def _(t):
    return sla.lodgements(t, TERMS, AS_OF, **ALL)


@query("j07_enhancement", CUBES["j07_enhancement"])
def _(t):
    return sla.enhancements(t, AS_OF, **ALL)


@query("j08_board_enhancement", BOARDS["j08_board_enhancement"])
def _(t):
    return sla.enhancement_arm(t, AS_OF)


@query("j09_board_repayment", BOARDS["j09_board_repayment"])
def _(t):
    return sla.repayment_arm(t, AS_OF)


@query("j10_board_withdrawal", BOARDS["j10_board_withdrawal"])
def _(t):
    return sla.withdrawal_arm(t, AS_OF)


@query("j11_board_foreclosure", BOARDS["j11_board_foreclosure"])
def _(t):
    return sla.foreclosure_arm(t, TERMS, AS_OF)


@query("j12_board_lien_removal", BOARDS["j12_board_lien_removal"])
def _(t):
    return sla.lien_removal_arm(t, TERMS, AS_OF)


@query("j13_board_opening", BOARDS["j13_board_opening"])
def _(t):
    return sla.credit_arms(t, TERMS, AS_OF, [sla.OPENING_BOARD])


@query("j14_board_lodgement", BOARDS["j14_board_lodgement"])
def _(t):
    return sla.credit_arms(t, TERMS, AS_OF, [sla.LODGEMENT_BOARD])


@query("j15_scoreboard", BOARDS["j15_scoreboard"])
def _(t):
    return sla.scoreboard(t, TERMS, AS_OF).drop("update_date")


@query(
    "e3_scoreboard_display",
    f"""select channel_type as "Request Type", success_within_sla as "Resolved within SLA", success_l1 as "L1 Resolved SLA Breached",
        success_l2 as "L2 Resolved SLA Breached", success_l3 as "L3 Resolved SLA Breached", non_success_within_sla as "Unresolved within SLA",
        non_success_l1 as "1D Unresolved SLA Breached", non_success_l2 as "3D Unresolved SLA Breached",
        non_success_l3 as "5D Unresolved SLA Breached", non_success_l4 as "5D+ Unresolved SLA Breached", lender_id as "Lender"
        from ({BOARDS['j15_scoreboard']})""",
)
def _(t):
    return sla.scoreboard(t, TERMS, AS_OF, display=True)
