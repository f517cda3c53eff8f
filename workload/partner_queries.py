"""Lead funnel, partner payouts and partner scorecard on the stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanops.plans import funnel, journey, partners
from workload.journey_queries import PORTFOLIO
from workload.registry import query
from workload.standins import EVENTS_AS_OF

PLATFORM = 4
START = "2017-01-01"
HISTORY_START = "2023-09-15 00:00:00"
EXCLUDED = (17, 23)
# A share of the rows that every key has: all of them are spread.
EVERY_KEY = 10**9
ALL_DATES = {"history_start": HISTORY_START, "exclude_ids": EXCLUDED}

FUNNEL = """
  select x.application_id, b.account_holderpan as app_pan, b.account_holder_phone_number as app_phone_number,
    m.available_portfolio_value as app_available_portfolio_value, m.eligible_portfolio_value as app_eligible_portfolio_value,
    m.eligible_credit_limit as app_eligible_credit_limit, m.pledged_portfolio_value as app_pledged_portfolio_value,
    m.pledged_credit_limit as app_pledged_credit_limit, coalesce(x.current_step_id, 'COMPLETED') as current_step_id,
    x.last_updated_on as app_last_updated_on, x.platform_account_id, x.partner_account_id, p.partner_account_type,
    coalesce(f.platform_name, 'HOUSE') as platform_name, p.partner_name, x.application_state, x.completed_on,
    a.app_created_on, x.lender_account_id, b.account_holder_name, x.application_type, g.cams_fetched, g.karvy_fetched,
    b.account_holder_email, n.mf_count
  from credit_applications_entity x
  join (select account_id, min(created_on) as app_created_on from credit_applications_entity
        where application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER' group by account_id) a on a.account_id = x.account_id
  left join credit_application_meta_data m on m.application_id = x.application_id
  left join borrower_accounts b on b.account_id = x.account_id
  left join partner_accounts p on p.account_id = x.partner_account_id
  left join platform_accounts f on f.account_id = x.platform_account_id
  left join (select application_id, max(if(asset_repository = 'CAMS', 'Y', 'N')) as cams_fetched,
               max(if(asset_repository = 'KARVY', 'Y', 'N')) as karvy_fetched from asset_fetch_data group by 1) g
    on g.application_id = x.application_id
  left join (select application_id, count(isin_no) as mf_count from asset_pledge_data group by 1) n
    on n.application_id = x.application_id
  where x.application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER' and b.account_holderpan is not null"""

MESSAGES = """
  select r.message_type, r.primary_recipient, r.record_created_on, r.record_last_updated_on, r.status as email_status
  from communication_message_records r
  join (select primary_recipient, max(record_last_updated_on) as best from communication_message_records
        where message_type = 'EMAIL' group by 1) b
    on r.primary_recipient = b.primary_recipient and r.record_last_updated_on = b.best
  where r.message_type = 'EMAIL'"""

LEAD_FUNNEL = f"""
  with portfolio as ({PORTFOLIO}), apps as ({FUNNEL}), mail as ({MESSAGES}),
  leads as (select l.*, f.platform_name from customer_leads l left join platform_accounts f on f.account_id = l.platform_account_id
            where l.platform_account_id = {PLATFORM}),
  best as (select pan, min(q.created_on) as best from leads join portfolio q using (lead_id) where pan is not null group by pan),
  firsts as (select l.*, q.mfc_eligible_credit_limit, q.created_on from leads l left join portfolio q on q.lead_id = l.lead_id),
  picked as (select r.*, mail.email_status from firsts r join best b on r.pan = b.pan and r.created_on is not distinct from b.best
             left join mail on mail.primary_recipient = r.email_id),
  paired as (
    select coalesce(v.pan, a.app_pan) as account_holderpan, coalesce(a.app_phone_number, v.phone_number) as account_holder_phone_number,
      a.application_id,
      case when (a.platform_account_id = v.platform_account_id and a.app_created_on < v.created_date_time)
             or v.created_date_time is null then a.app_created_on else v.created_date_time end as created,
      a.completed_on as completed, a.current_step_id as step, a.cams_fetched, a.karvy_fetched, v.mfc_eligible_credit_limit,
      a.app_eligible_credit_limit, a.app_pledged_credit_limit, coalesce(v.email_id, a.account_holder_email) as email_address,
      a.mf_count, v.request_id, coalesce(a.platform_name, v.platform_name) as platform_name,
      v.created_date_time as mfc_created_on, a.app_created_on, v.email_status
    from apps a full join picked v on a.app_pan = v.pan
    where a.platform_account_id = {PLATFORM} or v.platform_account_id = {PLATFORM}),
  dated as (
    select * exclude (created, completed, step), cast(created + interval '330 minutes' as date) as created_on,
      cast(completed + interval '330 minutes' as date) as completed_on,
      case when application_id is null and step is null then 'MFC Fetched' else step end as current_step_id
    from paired)
  select * from dated where created_on >= date '{START}' or completed_on >= date '{START}'"""

SPANS = """select destination_id as partner_account_id, credit_account_number, min(payment_date) as first_payment_date,
    max(payment_date) as last_payment_date from payout_transactions where payment_date is not null group by all"""
STATUS = """select p.account_id as partner_account_id, p.partner_name, p.bank_account_number, p.bank_accountifsccode,
    cast(f.first_on + interval '330 minutes' as date) as activation_date,
    if(f.first_on is null, 'empanelled', 'activated') as account_status
    from partner_accounts p left join (select partner_account_id, min(created_on) as first_on from credit_main group by 1) f
      on f.partner_account_id = p.account_id"""

EFFECTIVE = """
  select c.lender_account_id, c.application_id, c.account_id, c.partner_account_id, c.platform_account_id, c.application_type,
    c.current_step_id, case when c.application_state = 'SUSPENDED' and h.application_id is not null then 'COMPLETED'
      else c.application_state end as application_state,
    c.last_updated_on, c.created_on, 'DEFAULTED DATE' as date_source, c.completed_on
  from credit_applications_entity c
  left join (select application_id from credit_applications_entity_audit where application_state = 'COMPLETED') h
    on h.application_id = c.application_id
  where c.application_state in ('COMPLETED', 'SUSPENDED')"""
EFFECTIVE_ONCE = f"select distinct * from ({EFFECTIVE})"

DATES = f"""
  with eff as ({EFFECTIVE}),
  running as (select application_id, max(last_updated_on) as until from credit_applications_entity_audit
              where application_state = 'IN_PROGRESS' group by 1),
  first_credit as (select account_id, min(created_on) as created_on from credit_main
                   where created_on < timestamp '{HISTORY_START}' group by 1)
  select application_id, completed_on, 'COMPLETED_ON AVAILABLE' as date_source from eff
  where completed_on is not null and application_state = 'COMPLETED' and last_updated_on >= timestamp '{HISTORY_START}'
  union
  select h.application_id, min(h.last_updated_on), 'AUDIT_TABLE AVAILABLE' from running r
  join credit_applications_entity_audit h on h.application_id = r.application_id
  where h.application_state = 'COMPLETED' and h.last_updated_on > r.until and r.application_id in
    (select application_id from eff where application_state = 'COMPLETED' and completed_on is null)
  group by 1
  union
  select application_id, last_updated_on, 'ENHANCEMENT BEFORE AUDIT TABLE' from eff
  where application_type <> 'CREDIT_AGAINST_SECURITIES_BORROWER' and application_state = 'COMPLETED'
    and last_updated_on < timestamp '{HISTORY_START}'
  union
  select e.application_id, f.created_on, 'FIRST APPLICATION BEFORE AUDIT TABLE' from eff e
  join first_credit f on f.account_id = e.account_id
  where e.created_on < f.created_on and e.application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER'
    and e.application_state = 'COMPLETED' and e.application_id not in {EXCLUDED} and e.completed_on is null"""

CREDITS = f"""
  with eff2 as ({EFFECTIVE}), dates as ({DATES})
  select e.lender_account_id, f.platform_name, e.partner_account_id, p.partner_account_type, e.account_id, e.application_id,
    e.application_type, 'COMPLETED' as current_step_id, 'COMPLETED' as application_state, m.eligible_credit_limit,
    m.pledged_credit_limit, coalesce(d.date_source, e.date_source) as data_source,
    coalesce(d.completed_on, e.completed_on) + interval '330 minutes' as current_step_started_on
  from eff2 e left join credit_application_meta_data m on m.application_id = e.application_id
  left join partner_accounts p on p.account_id = e.partner_account_id
  left join platform_accounts f on f.account_id = e.platform_account_id
  left join dates d on d.application_id = e.application_id
  where e.application_state = 'COMPLETED' and e.partner_account_id is not null"""

_MONTH = f"date_trunc('month', timestamp '{EVENTS_AS_OF}')"
HISTORY = f"""
  select partner_account_id, min(current_step_started_on) as partner_activated_on,
    max(current_step_started_on) as partner_last_app_date, max(pledged_credit_limit) as max_pledged_credit_limit,
    sum(pledged_credit_limit) as sum_pledged_credit_limit,
    count(case when application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER' then application_id end) as total_customers,
    {_MONTH} - interval '2 months' as previous_month,
    date_trunc('month', min(current_step_started_on)) as partner_activated_month,
    date_trunc('month', max(current_step_started_on)) as partner_last_app_month
  from ({CREDITS}) where date_trunc('month', current_step_started_on) <= {_MONTH} - interval '2 months' group by 1"""
CLASSES = f"""
  with paced as (select *, (year(previous_month) - year(partner_activated_month)) * 12
      + month(previous_month) - month(partner_activated_month) as month_count from ({HISTORY})),
  rated as (select *, total_customers / nullif(cast(month_count as double), 0) as average_customer_per_month from paced)
  select * exclude (previous_month),
    case when date_part('day', {_MONTH} - interval '31 days' - partner_activated_on) < 45 then 'Activations < 45 days'
         when sum_pledged_credit_limit >= 10000000 and total_customers >= 5 and max_pledged_credit_limit >= 2000000
           and average_customer_per_month >= 1.5 then 'GOLD' else 'REST' end as mfd_group_1,
    date_part('day', {_MONTH} - interval '1 day' - partner_last_app_month) as days_diff,
    case when date_part('day', {_MONTH} - interval '31 days' - partner_last_app_date) > 45 then 'CHURN'
         when date_part('day', {_MONTH} - interval '31 days' - partner_last_app_date) <= 45 then 'ACTIVE' end as mfd_group_2
  from rated"""
LAST_MONTH = f"""
  select partner_account_id, min(current_step_started_on) as partner_activated_on,
    max(current_step_started_on) as partner_last_app_date, sum(pledged_credit_limit) as sum_pledged_credit_limit,
    count(distinct application_id) as applications,
    count(distinct application_id) filter (application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER') as total_new_applications,
    count(distinct application_id) filter (application_type = 'CREDIT_RENEWAL_AGAINST_SECURITIES') as total_renewal_applications,
    count(distinct application_id) filter (application_type <> 'CREDIT_AGAINST_SECURITIES_BORROWER') as total_existing_applications,
    sum(pledged_credit_limit) filter (application_type = 'CREDIT_AGAINST_SECURITIES_BORROWER') as total_new_pledged_limits,
    sum(pledged_credit_limit) filter (application_type = 'CREDIT_RENEWAL_AGAINST_SECURITIES') as total_renewal_pledged_limits
  from ({CREDITS}) where date_trunc('month', current_step_started_on) = {_MONTH} - interval '1 month' group by 1"""
SCORECARD = f"""
  select coalesce(c.partner_account_id, n.partner_account_id) as partner_account_id,
    coalesce(c.partner_activated_on, n.partner_activated_on) as partner_activated_on,
    coalesce(c.partner_last_app_date, n.partner_last_app_date) as partner_last_app_date,
    if(c.partner_activated_on is null, 'New MFD', c.mfd_group_1) as mfd_group_1,
    if(c.partner_activated_on is null, 'New MFD', c.mfd_group_2) as mfd_group_2,
    c.average_customer_per_month, c.total_customers as prev_total_customers,
    c.sum_pledged_credit_limit as prev_sum_pledged_credit_limit, c.max_pledged_credit_limit as prev_max_pledged_credit_limit,
    if(n.applications > 0, 'case done', 'case not done') as case_done_flag, n.applications as current_applications,
    n.total_new_applications as current_new_applications, n.total_renewal_applications as current_renewal_applications,
    n.total_existing_applications as current_existing_applications, n.total_new_pledged_limits as current_new_pledged_limits,
    n.total_renewal_pledged_limits as current_renewal_pledged_limits, n.sum_pledged_credit_limit as current_sum_pledged_credit_limit
  from ({LAST_MONTH}) n full join ({CLASSES}) c on c.partner_account_id = n.partner_account_id"""


def _credits(t):
    return partners.completed_credits(t, **ALL_DATES, expand=False)


@query("j30_application_funnel", FUNNEL)
def _(t):
    return funnel.application_funnel(t)


@query("j31_latest_message", MESSAGES)
def _(t):
    return funnel.latest_message_status(t["communication_message_records"])


@query("j32_platform_lead_funnel", LEAD_FUNNEL)
def _(t):
    return funnel.platform_lead_funnel(t, journey.portfolio_leads(t), PLATFORM, START)


@query("j32_platform_lead_funnel_hot", LEAD_FUNNEL)
def _(t):
    return funnel.platform_lead_funnel(t, journey.portfolio_leads(t), PLATFORM, START, hot_parts=EVERY_KEY)


@query("j33_payment_spans", SPANS)
def _(t):
    return partners.payment_spans(t["payout_transactions"])


@query("j34_partner_status", STATUS)
def _(t):
    return partners.partner_status(t)


PAYOUT_CHECK = f"""select coalesce(s.partner_account_id, p.partner_account_id) as partner_account_id, s.* exclude (partner_account_id),
        p.* exclude (partner_account_id) replace (
          if(trim(bank_account_number) <> '', '[' || trim(bank_account_number) || ']', trim(bank_account_number)) as bank_account_number)
        from ({SPANS}) s full join ({STATUS}) p on p.partner_account_id = s.partner_account_id"""


@query("j35_partner_payout_check", PAYOUT_CHECK)
def _(t):
    return partners.partner_payout_check(t)


@query("j35_partner_payout_check_hot", PAYOUT_CHECK)
def _(t):
    return partners.partner_payout_check(t, hot_parts=EVERY_KEY)


@query("j42_effective_applications", EFFECTIVE)
def _(t):
    return partners.effective_applications(t)


@query("j42_effective_applications_hot", EFFECTIVE)
def _(t):
    return partners.effective_applications(t, hot_parts=EVERY_KEY)


@query("j42_effective_once", EFFECTIVE_ONCE)
def _(t):
    return partners.effective_applications(t, dedupe_history=True)


@query("j43_completion_dates", DATES)
def _(t):
    return partners.completion_dates(t, HISTORY_START, EXCLUDED)


@query("j44_completed_credits", CREDITS)
def _(t):
    return partners.completed_credits(t, HISTORY_START, EXCLUDED)


@query("j44_completed_credits_hot", CREDITS)
def _(t):
    return partners.completed_credits(t, HISTORY_START, EXCLUDED, hot_parts=EVERY_KEY)


@query("j45_partner_history", HISTORY)
def _(t):
    return partners.partner_history(_credits(t), EVENTS_AS_OF)


@query("j46_partner_classes", CLASSES)
def _(t):
    return partners.partner_classes(partners.partner_history(_credits(t), EVENTS_AS_OF), EVENTS_AS_OF)


@query("j47_partner_last_month", LAST_MONTH)
def _(t):
    return partners.partner_last_month(_credits(t), EVENTS_AS_OF)


@query("j48_partner_scorecard", SCORECARD)
def _(t):
    return partners.partner_scorecard(t, HISTORY_START, EVENTS_AS_OF, EXCLUDED)
