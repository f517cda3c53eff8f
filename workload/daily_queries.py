"""Daily extracts, mandates and tickets on the stand-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.functions.rules import flatten
from loanops.operators.aggregates import count_columns
from loanops.operators.bitmaps import distinct_state, merged_counts, with_dense_ids
from loanops.operators.joins import semi_ids
from loanops.plans import daily, mandates, tickets
from workload.registry import query
from workload.standins import AS_OF

NOW = f"timestamp '{AS_OF}'"
DAY = f"date_trunc('day', {NOW})"
FORECLOSED = f"""
  select r.associated_collection_id as collection_id, b.account_holderpan, b.account_holder_name, r.request_id,
    m.lender_loan_account_number, m.lender_credit_id, r.status, r.created_on + interval '330 minutes' as created_on,
    r.last_updated_on + interval '330 minutes' as last_updated_on, r.lender_id, r.credit_id, r.amount_due
  from foreclosure_requests r left join credit_main m on m.credit_id = r.credit_id
  left join borrower_accounts b on b.account_id = r.account_id
  where r.created_on + interval '330 minutes' < {DAY} + interval '750 minutes'
    and r.created_on + interval '330 minutes' > {DAY} - interval '1 day' + interval '750 minutes'"""
COLLECTED = f"""
  select f.*, c.actual_amount_collected, c.transaction_id,
    coalesce(c.callback_received_on, c.last_updated_on) + interval '330 minutes' as callback_received_on
  from ({FORECLOSED}) f left join collections c on c.collection_id = f.collection_id"""
REPAID = f"""
  select c.collection_id, l.lender_credit_id as lan, b.account_holder_name, c.payment_date, c.actual_amount_collected,
    c.collection_type, c.pg_response ->> '$.bankRefNo' as bank_ref_no, c.pg_response ->> '$.paymentMode' as payment_mode,
    c.pg_response ->> '$.pgTrackingId' as pg_tracking_id
  from collections c join credits l on l.credit_id = c.credit_id and l.lending_partner_id = 'Beta'
  left join borrower_accounts b on b.account_id = l.account_id
  where c.collection_status in ('COLLECTION_COMPLETE', 'SETTLED')
    and (cast(c.payment_date as date) = date '1999-06-15'
         or (cast(c.payment_date as date) < date '1999-06-15' and c.last_updated_on > timestamp '1999-06-15 09:00:00'))"""

MANDATE_AS_OF = "2024-01-12 10:00:00"
MANDATES = f"""
  select application_id, created_date_time + interval '330 minutes' as created_date_time, bank_account_number, bank_ifsc_code,
    mandate_status, save_mandate_request ->> '$.k' as mandate_request_id,
    mandate_data ->> '$.emandate_error_message' as emandate_error_message, mandate_data ->> '$.emandate_status' as emandate_status
  from mandate_audit
  where cast(cast(created_date_time + interval '330 minutes' as date) as timestamp)
    > date_trunc('day', timestamp '{MANDATE_AS_OF}') + interval '330 minutes' - interval '6 days'"""
SUMMARY = f"""
  select 'Alpha' as lender, cast(created_date_time as date) as date,
    cast(date_trunc('week', created_date_time) as timestamp) as week_start,
    cast(date_trunc('month', created_date_time) as timestamp) as month_start,
    count(distinct mandate_request_id) as total_mandate_attempts_events,
    count(distinct case when mandate_status = 'Finished' then mandate_request_id end) as total_mandate_success_events,
    count(distinct case when mandate_status = 'Failed' then mandate_request_id end) as total_mandate_failed_events,
    count(distinct application_id) as total_applications_attempts,
    count(distinct case when mandate_status = 'Finished' then application_id end) as total_applications_success_attempts,
    count(distinct case when mandate_status = 'Failed' then application_id end) as total_applications_failed_attempts
  from ({MANDATES}) group by all"""


@query("j36_foreclosures_of_day", FORECLOSED)
def _(t):
    return daily.foreclosures_of_day(t, AS_OF)


@query("j37_foreclosure_collections", COLLECTED)
def _(t):
    return daily.foreclosure_collections(t, AS_OF)


@query("b17_split_by_lender", f"select *, if(lender_id in ('Alpha', 'Beta'), lender_id, 'rest') as part from ({COLLECTED})")
def _(t):
    parts = daily.by_lender(daily.foreclosure_collections(t, AS_OF), ["Alpha", "Beta"])
    return reduce(DataFrame.unionByName, [f.withColumn("part", F.lit(name or "rest")) for name, f in parts.items()])


@query("j38_repayments_of_day", REPAID)
def _(t):
    return daily.repayments_of_day(t, "1999-06-16 08:00:00", "Beta")


def _mandate_events(t):
    return mandates.mandate_events(t["mandate_audit"], MANDATE_AS_OF, request_field="k")


@query("j39_mandate_events", MANDATES)
def _(t):
    return _mandate_events(t)


@query("j40_mandate_summary", SUMMARY)
def _(t):
    return mandates.mandate_summary(_mandate_events(t), "Alpha")


_COUNTS = """count(distinct mandate_request_id) as total_mandate_attempts_events,
    count(distinct case when mandate_status = 'Finished' then mandate_request_id end) as total_mandate_success_events,
    count(distinct case when mandate_status = 'Failed' then mandate_request_id end) as total_mandate_failed_events,
    count(distinct application_id) as total_applications_attempts,
    count(distinct case when mandate_status = 'Finished' then application_id end) as total_applications_success_attempts,
    count(distinct case when mandate_status = 'Failed' then application_id end) as total_applications_failed_attempts"""


@query(
    "j40_mandate_rollup",
    " union all ".join(
        f"""select 'Alpha' as lender, '{unit}' as unit, cast(date_trunc('{name}', created_date_time) as date) as start, {_COUNTS}
            from ({MANDATES}) group by all"""
        for unit, name in (("D", "day"), ("W", "week"), ("M", "month"))
    ),
)
def _(t):
    events = with_dense_ids(_mandate_events(t), "mandate_request_id", "request_number")
    return mandates.mandate_rollup(events, "Alpha", "request_number")


@query(
    "d12_merged_bitmaps",
    """select month(o_orderdate) as month, count(distinct o_custkey) as customers,
       count(distinct case when o_orderstatus = 'F' then o_custkey end) as customers_served, count(distinct o_orderkey) as orders
       from orders group by 1""",
)
def _(t):
    """Counted by month of a year, read by month of any year."""
    test = F.col("o_orderstatus") == "F"
    counts = {"customers": ("o_custkey", None), "customers_served": ("o_custkey", test), "orders": ("o_orderkey", None)}
    state = distinct_state(t["orders"].withColumn("year_month", F.trunc("o_orderdate", "month")), ["year_month"], counts)
    return merged_counts(state.withColumn("month", F.month("year_month")), ["month"], list(counts))


@query("j41_status_counts", "select mandate_status, count(*) as count from mandate_audit group by all")
def _(t):
    return mandates.status_counts(t["mandate_audit"])


@query(
    "j41_application_counts",
    """select application_id, count(case when mandate_status = 'In Progress' then application_id end) as inprogress,
       count(case when mandate_status = 'Finished' then application_id end) as finished from mandate_audit group by all""",
)
def _(t):
    return mandates.application_counts(t["mandate_audit"])


@query(
    "j41_application_record",
    """select application_id, save_mandate_request ->> '$.k' as mandate_request_id, mandate_status, last_updated_on,
       save_mandate_request, save_mandate_response from mandate_audit where application_id = 7""",
)
def _(t):
    return mandates.application_record(t["mandate_audit"], 7, request_field="k")


@query(
    "j41_columns_per_date",
    f"""select date, count(mandate_request_id) as mandate_request_id, count(application_id) as application_id,
        count(mandate_status) as mandate_status from (select *, cast(created_date_time as date) as date from ({MANDATES}))
        where date is not null group by date""",
)
def _(t):
    events = _mandate_events(t).withColumn("date", F.to_date("created_date_time"))
    return count_columns(events.select("date", "mandate_request_id", "application_id", "mandate_status"), ["date"])


@query("j41_full_scan", "select * from mandate_audit")
def _(t):
    return t["mandate_audit"]


# One ticket per message: the nested form is built by Spark from the flat rows.
def _ticket_rows(t):
    return t["conversations"].select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.when(F.col("turn") > 2, "solved").otherwise("open").alias("status"),
        F.col("text").alias("subject"),
        F.col("role").alias("type"),
        F.col("conv_id").alias("requester_id"),
        F.when(F.col("turn") > 0, F.col("turn")).alias("assignee_id"),
        F.array(F.col("role"), F.lit("chat")).alias("tags"),
        F.when(F.col("turn") == 1, F.array().cast("array<struct<id:bigint,value:string>>"))
        .otherwise(
            F.array(
                F.struct(F.col("turn").alias("id"), F.col("role").alias("value")),
                F.struct(F.lit(2).cast("bigint").alias("id"), F.upper("role").alias("value")),
                F.struct((F.col("turn") + 4).alias("id"), F.col("text").alias("value")),
            )
        )
        .alias("custom_fields"),
    )


@query(
    "j49_tickets",
    """select conv_id * 100 + turn as id, case when turn > 2 then 'solved' else 'open' end as status, text as subject,
       role as type, conv_id as requester_id, case when turn > 0 then turn end as assignee_id, role || ',chat' as tags,
       case when turn = 1 then null when turn = 2 then role else upper(role) end as stage,
       case when turn = 1 then null when turn = 5 then role when turn + 4 = 5 then text end as note from conversations""",
)
def _(t):
    shown = tickets.tickets(_ticket_rows(t), {2: "stage", 5: "note"}, display=False)
    return shown.withColumn("tags", F.concat_ws(",", "tags"))


@query(
    "g24_flatten",
    """select conv_id as "ticket.id", role as "ticket.via.channel", turn as "ticket.via.source.rank", text as "subject" from conversations""",
)
def _(t):
    nested = t["conversations"].select(
        F.struct(
            F.col("conv_id").alias("id"),
            F.struct(F.col("role").alias("channel"), F.struct(F.col("turn").alias("rank")).alias("source")).alias("via"),
        ).alias("ticket"),
        F.col("text").alias("subject"),
    )
    return flatten(nested)


@query(
    "b16_semi_ids",
    f"select * from collections where collection_id in (select collection_id from ({FORECLOSED}) where collection_id is not null)",
)
def _(t):
    return semi_ids(t["collections"], daily.foreclosures_of_day(t, AS_OF), "collection_id", "collection_id")
