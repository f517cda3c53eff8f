"""The domain's source tables, derived from the given test tables.

Each stand-in is one SELECT that Spark and DuckDB both understand; ``{ntz}`` is the name of the zoneless
timestamp type and ``{table}`` a given table. Each reads a whole table. Nulls, unknown lenders and missing
dates are made on purpose, because the given tables have none.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from loanops.sources.catalog import Tables

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

AS_OF = "1999-06-15 13:45:00"
EVENTS_AS_OF = "2024-01-20 12:00:00"

_CREATED = "o_orderdate + interval '1' minute * (o_orderkey % 1440)"
_UPDATED = (
    "case when o_orderkey % 41 = 0 then null "
    "when o_orderkey % 5 = 0 then cast('1999-06-15 00:00:00' as {ntz}) + interval '1' minute * (o_orderkey % 1440) "
    "else o_orderdate + interval '1' minute * (o_orderkey % 1440 + (o_orderkey * 7) % 9000) end"
)
_LENDER = "case {key} % 4 when 0 then 'Alpha' when 1 then 'Beta' when 2 then 'Gamma' end"
_CREDIT_BASE = "cast('1996-01-01 00:00:00' as {{ntz}}) + interval '1' minute * (({key} * 191) % 2000000)"
_APP_TIME = "ts - interval '1' day * (event_id % 200)"


def _lender(key: str) -> str:
    return _LENDER.replace("{key}", key)


def _credit_base(key: str) -> str:
    return _CREDIT_BASE.format(key=key)


_REQUEST_STATUS = (
    "case when o_orderstatus = 'F' then 'SUCCESS' when o_orderstatus = 'O' then 'REQUESTED' "
    "when o_orderkey % 2 = 0 then 'FAILED' else 'IN_REVIEW' end"
)

STANDINS = {
    # ---- servicing
    "credits": f"""
        select c_custkey as credit_id, c_custkey as account_id, 'LC' || cast(c_custkey as string) as lender_credit_id,
               {_lender('c_custkey')} as lending_partner_id
        from {{customer}}""",
    "disbursals": f"""
        select o_orderkey as disbursal_id, o_custkey as credit_id,
               case when o_orderstatus = 'F' then 'SETTLED' when o_orderstatus = 'O' then 'PENDING'
                    when o_orderkey % 2 = 0 then 'REJECTED' else 'FAILED' end as disbursal_status,
               {_CREATED} as requested_on, {_UPDATED} as last_updated_on,
               case when o_orderkey % 13 > 0 then {_CREATED} + interval '1' hour * (o_orderkey % 29) end
                 as expected_transfer_by
        from {{orders}}""",
    "collections": f"""
        select o_orderkey as collection_id, o_custkey as credit_id,
               case when o_orderstatus = 'F' then 'SETTLED'
                    when o_orderstatus = 'O' then
                      case o_orderkey % 3 when 0 then 'REQUESTED' when 1 then 'COLLECTION_COMPLETE' else 'PENDING' end
                    when o_orderkey % 2 = 0 then 'CANCELLED' else 'FAILED' end as collection_status,
               case when o_orderkey % 2 = 0 then 'INTEREST' else 'PRINCIPAL' end as collection_type,
               {_CREATED} as created_on, {_UPDATED} as last_updated_on,
               case when o_orderkey % 13 > 0 then {_CREATED} + interval '1' hour * (o_orderkey % 29) end
                 as settlement_expected_by,
               {_CREATED} as payment_date,
               cast(o_totalprice as decimal(18,2)) as actual_amount_collected,
               'T' || cast(o_orderkey as string) as transaction_id,
               case when o_orderkey % 3 > 0 then {_UPDATED} end as callback_received_on,
               '{{{{"bankRefNo":"B' || cast(o_orderkey as string) || '","paymentMode":"' || o_orderpriority
                 || '","statusMessage":"ok"}}}}' as pg_response
        from {{orders}}""",
    "enhance_limit_request": f"""
        select o_orderkey as request_id, o_custkey as credit_id, {_REQUEST_STATUS} as status,
               {_CREATED} as created_on, {_UPDATED} as last_updated_on
        from {{orders}}""",
    # ---- origination and history
    "revocation_requests": f"""
        select o_orderkey as request_id, o_orderkey + 3 as credit_id, {_REQUEST_STATUS} as status,
               {_CREATED} as created_on, {_UPDATED} as last_updated_on
        from {{orders}}""",
    "foreclosure_requests": f"""
        select o_orderkey as request_id, o_custkey as account_id, o_orderkey as credit_id,
               o_orderkey + 1 as associated_collection_id, {_lender('o_custkey')} as lender_id, {_REQUEST_STATUS} as status,
               cast(o_totalprice as decimal(18,2)) as amount_due,
               case when o_orderkey % 3 = 0
                    then cast('1999-06-14 00:00:00' as {{ntz}}) + interval '1' minute * (o_orderkey % 2880)
                    else {_CREATED} end as created_on,
               {_UPDATED} as last_updated_on
        from {{orders}}""",
    "credit_main": f"""
        select o_orderkey as credit_id, o_custkey as account_id,
               case when o_orderkey % 6 > 0 then o_custkey % 12 end as partner_account_id,
               {_lender('o_orderkey')} as lending_partner_id,
               'L' || cast(o_orderkey as string) as lender_loan_account_number,
               'LC' || cast(o_orderkey as string) as lender_credit_id,
               case o_orderkey % 7 when 0 then 'PENDING_DISBURSAL_APPROVAL' when 1 then 'PENDING_LODGEMENT'
                    when 2 then 'APPROVED_NOT_DISBURSED' when 3 then 'ACTIVE' when 4 then 'PENDING_CLOSURE'
                    when 5 then 'CLOSED' end as credit_status,
               {_credit_base('o_orderkey')} as created_on
        from {{orders}}""",
    "credit_audit": f"""
        select l_orderkey as credit_id,
               case l_linenumber when 1 then 'PENDING_DISBURSAL_APPROVAL' when 2 then 'PENDING_LODGEMENT'
                    when 3 then 'APPROVED_NOT_DISBURSED' when 4 then 'ACTIVE' when 5 then 'PENDING_CLOSURE'
                    else 'CLOSED' end as credit_status,
               {_credit_base('l_orderkey')} + interval '1' minute * ((l_partkey * 13 + l_linenumber * 97) % 5000)
                 as last_updated_on
        from {{lineitem}}""",
    "credit_applications_entity": f"""
        select event_id as application_id, user_id as account_id,
               case when event_id % 37 = 0 then null when event_id % 5 = 0 then 'CREDIT_RENEWAL_AGAINST_SECURITIES'
                    when event_id % 5 = 1 then 'CREDIT_ENHANCEMENT'
                    else 'CREDIT_AGAINST_SECURITIES_BORROWER' end as application_type,
               case event_type when 'purchase' then 'COMPLETED' when 'view' then 'COMPLETED' when 'signup' then 'SUSPENDED'
                    when 'click' then 'IN_PROGRESS' end as application_state,
               case when event_type in ('click', 'error') then 'MF_FETCH_PORTFOLIO'
                    when event_type = 'view' and event_id % 2 = 0 then 'ASSET_PLEDGE' end as current_step_id,
               case when event_id % 11 > 0 then event_id % 27 end as platform_account_id,
               case when event_id % 7 > 0 then event_id % 12 end as partner_account_id,
               user_id % 3 as lender_account_id,
               case when event_id % 29 > 0 then {_APP_TIME} end as created_on,
               {_APP_TIME} + interval '1' minute * (event_id % 3000) as last_updated_on,
               case when event_id % 3 > 0 and event_type in ('purchase', 'view')
                    then {_APP_TIME} + interval '1' hour * (event_id % 50) end as completed_on
        from {{events}}""",
    "credit_applications_entity_audit": """
        select event_id - event_id % 3 as application_id, user_id as account_id,
               case when event_id % 5 = 0 then 'CREDIT_RENEWAL_AGAINST_SECURITIES'
                    else 'CREDIT_AGAINST_SECURITIES_BORROWER' end as application_type,
               case when event_type in ('purchase', 'view') then 'COMPLETED'
                    when event_type = 'signup' and event_id % 2 = 0 then 'SUSPENDED' else 'IN_PROGRESS' end as application_state,
               case when event_id % 4 = 0 then 'ASSET_PLEDGE' when event_id % 4 < 3 then 'MF_FETCH_PORTFOLIO' end
                 as current_step_id,
               case when event_id % 11 > 0 then event_id % 27 end as platform_account_id,
               case when event_id % 7 > 0 then event_id % 12 end as partner_account_id,
               ts as created_on,
               case when event_id % 31 > 0 then cast(cast(ts as date) as {ntz}) + interval '1' hour * (event_id % 24) end
                 as last_updated_on,
               case when event_id % 3 = 0 then ts end as completed_on
        from {events}""",
    "credit_application_meta_data": """
        select event_id as application_id,
               cast(cast(value as decimal(18,2)) * 5000 as decimal(18,2)) as available_portfolio_value,
               cast(cast(value as decimal(18,2)) * 2500 as decimal(18,2)) as eligible_portfolio_value,
               case when event_id % 9 > 0 then cast(cast(value as decimal(18,2)) * 2000 as decimal(18,2)) end
                 as eligible_credit_limit,
               cast(case when event_id % 4 > 0 then cast(value as decimal(18,2)) * 1500 else 0 end as decimal(18,2))
                 as pledged_portfolio_value,
               case when event_id % 6 > 0 then cast(cast(value as decimal(18,2)) * 10000 as decimal(18,2)) end
                 as pledged_credit_limit,
               ts as created_on
        from {events}""",
    "customer_leads": f"""
        select o_orderkey as lead_id, case when o_orderkey % 97 > 0 then 'P' || cast(o_custkey as string) end as pan,
               case o_orderkey % 3 when 0 then '0' when 1 then '+91 ' else '' end
                 || cast(5000000000 + (o_orderkey * 1234567) % 5000000000 as string) as phone_number,
               case when o_orderkey % 11 > 0 then o_orderkey % 27 end as platform_account_id,
               case when o_orderkey % 7 > 0 then o_orderkey % 12 end as partner_account_id,
               case when o_orderkey % 17 > 0 then o_orderdate + interval '8000' day end as created_date_time,
               'Name ' || cast(o_custkey as string) as full_name,
               'user' || cast(o_custkey as string) || '@example.org' as email_id,
               'R' || cast(o_orderkey as string) as request_id
        from {{orders}}""",
    "leads_portfolio_data": """
        select l_orderkey as lead_id, cast(l_extendedprice as decimal(18,2)) as total_portfolio_value,
               cast(l_quantity as decimal(18,2)) as eligible_portfolio_value,
               cast(l_extendedprice as decimal(18,2)) as eligible_credit_limit,
               case when l_orderkey % 23 > 0 then l_shipdate + interval '8000' day end as created_on,
               case when l_orderkey % 19 > 0 then l_shipdate + interval '8000' day end as last_updated_on
        from {lineitem}""",
    "borrower_accounts": """
        select c_custkey as account_id, c_name as account_holder_name,
               case when c_custkey % 53 > 0 then 'P' || cast(c_custkey as string) end as account_holderpan,
               cast(9000000000 + c_custkey as string) as account_holder_phone_number,
               'holder' || cast(c_custkey as string) || '@example.org' as account_holder_email
        from {customer}""",
    "partner_accounts": """
        select s_suppkey as account_id, s_name as partner_name,
               case s_suppkey % 3 when 0 then 'INDIVIDUAL' when 1 then 'COMPANY' end as partner_account_type,
               case s_suppkey % 4 when 0 then '  ' || cast(s_suppkey * 1001 as string) || ' ' when 1 then '  '
                    when 2 then cast(s_suppkey * 1001 as string) end as bank_account_number,
               'IFSC' || cast(s_nationkey as string) as bank_accountifsccode
        from {supplier}""",
    "platform_accounts": "select n_nationkey as account_id, n_name as platform_name from {nation}",
    "asset_fetch_data": """
        select l_orderkey as application_id,
               case l_partkey % 3 when 0 then 'CAMS' when 1 then 'KARVY' else 'OTHER' end as asset_repository
        from {lineitem}""",
    "asset_pledge_data": """
        select l_orderkey as application_id,
               case when l_partkey % 4 > 0 then 'ISIN' || cast(l_partkey as string) end as isin_no
        from {lineitem}""",
    "communication_message_records": """
        select case when event_type in ('click', 'view', 'purchase') then 'EMAIL' else 'SMS' end as message_type,
               case when event_id % 13 > 0 then 'user' || cast(user_id as string) || '@example.org' end as primary_recipient,
               event_type as status, ts as record_created_on,
               cast(cast(ts as date) as {ntz}) as record_last_updated_on
        from {events}""",
    "mandate_audit": """
        select user_id as application_id, ts as created_date_time, 'A' || cast(user_id as string) as bank_account_number,
               'IFSC' || cast(user_id % 9 as string) as bank_ifsc_code,
               case event_type when 'purchase' then 'Finished' when 'error' then 'Failed' when 'click' then 'In Progress' end
                 as mandate_status,
               props as save_mandate_request, props as save_mandate_response,
               '{{"emandate_status":"' || event_type || '","emandate_error_message":"code ' || cast(event_id % 5 as string)
                 || '"}}' as mandate_data,
               ts as last_updated_on
        from {events}""",
    "payout_transactions": """
        select l_suppkey as destination_id, case when l_quantity > 3 then l_shipdate end as payment_date,
               'A' || cast(l_partkey % 50 as string) as credit_account_number
        from {lineitem}""",
}


_OPEN: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    """Given tables and stand-ins under one roof; opened once per session, as plans, not as data."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:

        def derive(name: str) -> DataFrame:
            sql = STANDINS[name]
            inputs = {t: opened[t] for t in BASE if "{" + t + "}" in sql}
            return spark.sql(sql.replace("{ntz}", "timestamp_ntz"), **inputs)

        base = {t: (lambda t=t: spark.read.parquet(f"{folder}/{t}.parquet")) for t in BASE}
        opened = Tables(base | {n: (lambda n=n: derive(n)) for n in STANDINS})
        _OPEN[key] = opened
    return _OPEN[key]


def oracle(body: str) -> str:
    """``body`` in DuckDB, with the stand-ins that it names put in front of it."""
    used = [n for n in STANDINS if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} as ({STANDINS[n].format(ntz='timestamp', **{t: t for t in BASE})})" for n in used)
    return f"with {ctes}\nselect * from ({body})" if used else body
