"""Journeys and rollups on the stand-ins."""

from __future__ import annotations

from loanops.constants import FETCH_STEP, PLEDGE_STEP
from loanops.plans import journey as J
from pyspark.sql import functions as F
from workload.registry import query
from workload.standins import EVENTS_AS_OF

PLATFORMS = J.Platforms(
    house_ids=(1, 2, 3),
    classes={
        "Direct": ["NATION_1", "NATION_2", "NATION_3"],
        "Software": ["NATION_5", "NATION_6", "NATION_7", "NATION_8"],
        "Business": [f"NATION_{n}" for n in range(10, 20)],
    },
)

_CHANNEL = """case when {a}.platform_account_id is not null and {a}.platform_account_id not in (1, 2, 3) then 'B2B'
    when {a}.partner_account_id is not null and p.partner_account_type = 'INDIVIDUAL' then 'B2B2C' else 'B2C' end as business_channel"""

PORTFOLIO = """select lead_id, total_portfolio_value as mfc_total_portfolio_value,
    eligible_portfolio_value as mfc_eligible_portfolio_value, eligible_credit_limit as mfc_eligible_credit_limit,
    created_on, last_updated_on from leads_portfolio_data"""

LEADS = f"""select l.lead_id, l.pan, l.partner_account_id, l.platform_account_id, l.phone_number as mfc_phone_number,
    f.platform_name, p.partner_name, p.partner_account_type, {_CHANNEL.format(a='l')}
    from customer_leads l left join platform_accounts f on f.account_id = l.platform_account_id
    left join partner_accounts p on p.account_id = l.partner_account_id"""

_AT_STEP = """select * exclude (rn) from (
      select *, row_number() over (partition by application_id order by last_updated_on desc nulls first,
        account_id nulls last, current_step_id nulls last, application_state nulls last, application_type nulls last,
        completed_on nulls last, created_on nulls last, platform_account_id nulls last, partner_account_id nulls last) as rn
      from credit_applications_entity_audit where current_step_id = '{step}' and application_state <> 'SUSPENDED') where rn = 1"""


def _facts(source: str) -> str:
    return f"""select x.application_id, b.account_holderpan as app_pan, b.account_holder_phone_number as app_phone_number,
      m.available_portfolio_value as app_available_portfolio_value, m.eligible_portfolio_value as app_eligible_portfolio_value,
      m.eligible_credit_limit as app_eligible_credit_limit, m.pledged_portfolio_value as app_pledged_portfolio_value,
      m.pledged_credit_limit as app_pledged_credit_limit, x.current_step_id as app_current_step_id,
      x.last_updated_on as app_last_updated_on, x.completed_on, x.application_type, x.application_state,
      x.platform_account_id, x.partner_account_id, p.partner_account_type, coalesce(f.platform_name, 'HOUSE') as platform_name,
      p.partner_name, {_CHANNEL.format(a='x')}, coalesce(x.created_on, m.created_on) as created_on
      from ({source}) x left join credit_application_meta_data m on m.application_id = x.application_id
      left join borrower_accounts b on b.account_id = x.account_id
      left join partner_accounts p on p.account_id = x.partner_account_id
      left join platform_accounts f on f.account_id = x.platform_account_id"""


FACTS = _facts("select * from credit_applications_entity where application_state <> 'SUSPENDED'")
FETCHED = _facts(_AT_STEP.format(step=FETCH_STEP))
PLEDGED = _facts(_AT_STEP.format(step=PLEDGE_STEP))
SANCTIONED = "select application_id, pledged_credit_limit as sanctioned_limit from credit_application_meta_data"

_PHONE = "regexp_replace(regexp_replace(phone, '\\D', '', 'g'), '^0+', '')"


def journey_sql(facts: str) -> str:
    return f"""
      with leads as ({LEADS}), portfolio as ({PORTFOLIO}), facts as ({facts}),
      best as (select pan, max(last_updated_on) as best from leads join portfolio using (lead_id)
               where pan is not null group by pan),
      lead_rows as (select l.*, q.* exclude (lead_id) from leads l left join portfolio q on q.lead_id = l.lead_id),
      latest as (select r.* from lead_rows r join best b on r.pan = b.pan and r.last_updated_on is not distinct from b.best),
      merged as (
        select coalesce(v.pan, a.app_pan) as pan, coalesce(a.platform_name, v.platform_name) as platform_name,
          coalesce(a.partner_name, v.partner_name) as partner_name,
          coalesce(a.partner_account_type, v.partner_account_type) as partner_account_type,
          coalesce(a.app_phone_number, v.mfc_phone_number) as phone,
          v.mfc_total_portfolio_value, v.mfc_eligible_portfolio_value, v.mfc_eligible_credit_limit,
          a.app_available_portfolio_value, a.app_eligible_portfolio_value, a.app_eligible_credit_limit,
          a.app_pledged_portfolio_value, a.app_current_step_id,
          coalesce(a.app_last_updated_on, v.last_updated_on) as last_updated_date,
          least(a.created_on, v.created_on) as created_on, a.completed_on,
          coalesce(a.business_channel, v.business_channel) as business_channel,
          coalesce(a.application_type, case when v.lead_id is not null then 'CREDIT_AGAINST_SECURITIES_BORROWER' end)
            as application_type,
          a.application_state, v.lead_id, a.application_id,
          case when a.app_eligible_credit_limit >= 25000 then a.app_eligible_credit_limit
               when v.mfc_eligible_credit_limit >= 25000 then v.mfc_eligible_credit_limit else 0 end as eligible_credit_limit_temp
        from facts a full join latest v on a.app_pan = v.pan),
      judged as (
        select * replace (coalesce(app_available_portfolio_value, 0) as app_available_portfolio_value,
                          coalesce(app_pledged_portfolio_value, 0) as app_pledged_portfolio_value)
        from merged where application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER' and eligible_credit_limit_temp >= 25000),
      staged as (
        select *, {_PHONE} as bare, case when application_state = 'COMPLETED' then 'Completed'
            when app_pledged_portfolio_value > 0 and application_state = 'IN_PROGRESS' then 'Post Pledge'
            when app_available_portfolio_value > 0 and app_pledged_portfolio_value = 0 then 'Post Fetch'
            when application_id is not null then 'Pre Fetch' else 'MFC Fetch' end as application_stage
        from judged)
      select pan, platform_name, partner_name, partner_account_type,
        case when regexp_full_match(case when length(bare) > 10 then regexp_replace(bare, '^91', '') else bare end, '[6-9][0-9]{{9}}')
             then case when length(bare) > 10 then regexp_replace(bare, '^91', '') else bare end end as phone_number,
        coalesce(mfc_total_portfolio_value, 0) as mfc_total_portfolio_value,
        coalesce(mfc_eligible_portfolio_value, 0) as mfc_eligible_portfolio_value,
        coalesce(mfc_eligible_credit_limit, 0) as mfc_eligible_credit_limit, app_available_portfolio_value,
        coalesce(app_eligible_portfolio_value, 0) as app_eligible_portfolio_value,
        coalesce(app_eligible_credit_limit, 0) as app_eligible_credit_limit,
        app_current_step_id, last_updated_date, created_on,
        case when application_stage = 'Completed' and completed_on is null then last_updated_date else completed_on end as completed_on,
        business_channel, application_stage, application_type, application_state, s.application_id,
        eligible_credit_limit_temp, 'Yes' as eligible,
        case when platform_name in ('NATION_1', 'NATION_2', 'NATION_3') then 'Direct'
             when platform_name in ('NATION_5', 'NATION_6', 'NATION_7', 'NATION_8') then 'Software'
             when platform_name in ({', '.join(f"'NATION_{n}'" for n in range(10, 20))}) then 'Business' else 'Other' end as platform_type,
        n.sanctioned_limit
      from staged s left join ({SANCTIONED}) n on n.application_id = s.application_id"""


JOURNEY, JOURNEY_FETCHED, JOURNEY_PLEDGED = journey_sql(FACTS), journey_sql(FETCHED), journey_sql(PLEDGED)
_DONE = "app_current_step_id is null and application_state = 'COMPLETED'"
_RECENT = f"completed_on >= timestamp '{EVENTS_AS_OF}' - interval '15 days'"


def _rollup(journey, date_column, fmt, period, key, name="platform_name", where="true"):
    return f"""select strftime({date_column}, '{fmt}') as {period}, {key} as {name}, count(*) as count,
      cast(coalesce(sum(sanctioned_limit), 0) as double) as approved_credit_count,
      cast(sum(eligible_credit_limit_temp) as double) / count(eligible_credit_limit_temp) as average_eligible_credit,
      round(median(cast(eligible_credit_limit_temp as double)), 4) as median_eligible_credit
      from ({journey}) where {date_column} is not null and {key} is not null and {where} group by all"""


def _two(journey, date_column, fmt, period, where="true"):
    return (
        _rollup(journey, date_column, fmt, period, "platform_name", where=where)
        + " union all "
        + _rollup(journey, date_column, fmt, period, "platform_type", where=where)
    )


def _rounded(frame):
    """Comparable cells: money as double, the median to four places."""
    return frame.withColumns(
        {
            "approved_credit_count": F.col("approved_credit_count").cast("double"),
            "median_eligible_credit": F.round("median_eligible_credit", 4),
        }
    )


def _journey(t, step=None):
    return J.journey_of(t, PLATFORMS, step)


@query("j17_portfolio_leads", PORTFOLIO)
def _(t):
    return J.portfolio_leads(t)


@query("j18_customer_leads", LEADS)
def _(t):
    return J.customer_leads(t, PLATFORMS)


@query("j19_application_facts", FACTS)
def _(t):
    return J.application_facts(t, PLATFORMS)


@query("j20_facts_fetch_step", FETCHED)
def _(t):
    return J.application_facts(t, PLATFORMS, FETCH_STEP)


@query("j21_facts_pledge_step", PLEDGED)
def _(t):
    return J.application_facts(t, PLATFORMS, PLEDGE_STEP)


@query("j22_sanctioned_amount", SANCTIONED)
def _(t):
    return J.sanctioned_amounts(t)


@query("j23_customer_journey", JOURNEY)
def _(t):
    return _journey(t)


@query("j23_customer_journey_hot", JOURNEY)
def _(t):
    return J.journey_of(t, PLATFORMS, hot_parts=10**9)


@query("j23_customer_journey_fetch", JOURNEY_FETCHED)
def _(t):
    return _journey(t, FETCH_STEP)


@query("j23_customer_journey_pledge", JOURNEY_PLEDGED)
def _(t):
    return _journey(t, PLEDGE_STEP)


@query("j24_completed_platform_month", _rollup(JOURNEY, "completed_on", "%Y-%m", "completed_month", "platform_name", where=_DONE))
def _(t):
    return _rounded(J.completed_by_platform(_journey(t), "M", EVENTS_AS_OF))


@query(
    "j24_completed_platform_day",
    _rollup(JOURNEY, "completed_on", "%Y-%m-%d", "completed_month", "platform_name", where=f"{_DONE} and {_RECENT}"),
)
def _(t):
    return _rounded(J.completed_by_platform(_journey(t), "D", EVENTS_AS_OF))


@query("j25_completed_type_month", _rollup(JOURNEY, "completed_on", "%Y-%m", "completed_month", "platform_type", where=_DONE))
def _(t):
    return _rounded(J.completed_by_type(_journey(t), "M", EVENTS_AS_OF))


@query("j26_registered_platform", _rollup(JOURNEY, "created_on", "%Y-%m", "created_month", "platform_name"))
def _(t):
    return _rounded(J.registered_by_platform(_journey(t), "M"))


@query("j27_registered_type", _rollup(JOURNEY, "created_on", "%Y-%m", "created_month", "platform_type"))
def _(t):
    return _rounded(J.registered_by_type(_journey(t), "M"))


@query(
    "j28_generic_rollup",
    f"""select strftime(created_on, '%Y-%m') as completed_period, business_channel, count(*) as count,
        cast(count(sanctioned_limit) as double) as approved_credit_count,
        cast(sum(eligible_credit_limit_temp) as double) / count(eligible_credit_limit_temp) as average_eligible_credit,
        round(median(cast(eligible_credit_limit_temp as double)), 4) as median_eligible_credit,
        cast(sum(eligible_credit_limit_temp) as double) as sum_eligible_credit
        from ({JOURNEY}) where created_on is not null and business_channel is not null and {_DONE} group by all""",
)
def _(t):
    frame = _rounded(J.completed_by(_journey(t), "created_on", "business_channel", "M"))
    return frame.withColumn("sum_eligible_credit", F.col("sum_eligible_credit").cast("double"))


def _published(t, title):
    steps = {"grouped fetched on": FETCH_STEP, "grouped pledged on": PLEDGE_STEP}
    if title in steps:
        return _rounded(J.step_rollup(_journey(t, steps[title])))
    return _rounded(J.current_rollups(_journey(t), EVENTS_AS_OF)[title])


@query("j29_completed_months", _two(JOURNEY, "completed_on", "%Y-%m", "completed_month", _DONE))
def _(t):
    return _published(t, "grouped completed on")


@query("j29_completed_days", _two(JOURNEY, "completed_on", "%Y-%m-%d", "completed_month", f"{_DONE} and {_RECENT}"))
def _(t):
    return _published(t, "grouped completed on days")


@query("j29_registered", _two(JOURNEY, "created_on", "%Y-%m", "created_month"))
def _(t):
    return _published(t, "grouped created on")


@query("j29_fetched", _two(JOURNEY_FETCHED, "created_on", "%Y-%m", "created_month"))
def _(t):
    return _published(t, "grouped fetched on")


@query("j29_pledged", _two(JOURNEY_PLEDGED, "created_on", "%Y-%m", "created_month"))
def _(t):
    return _published(t, "grouped pledged on")
