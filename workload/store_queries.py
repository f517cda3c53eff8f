"""Reports on tables that were laid out for them: histories stored by key, request tables stored by day."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.constants import FETCH_STEP, PLEDGE_STEP
from loanops.operators import history
from loanops.plans import journey, partners, sla
from loanops.session import checkpoint_folder
from loanops.sources import stores
from workload.journey_queries import FETCHED, PLATFORMS, PLEDGED
from workload.partner_queries import DATES, EFFECTIVE_ONCE, EXCLUDED, HISTORY_START
from workload.registry import query
from workload.sla_queries import RECENT_AS_OF, RECENT_CUBES, TERMS

BUCKETS = 16


def keyed(frame: DataFrame, key: str, by: str) -> stores.KeyedHistory:
    name = f"history_{uuid4().hex}"
    return stores.write_keyed(frame, name, key, by, BUCKETS, checkpoint_folder(frame.sparkSession))


def with_keyed_audit(t: Mapping[str, DataFrame]) -> dict:
    audit = keyed(t["credit_applications_entity_audit"], "application_id", "last_updated_on")
    return {**{n: t[n] for n in _APPLICATION_TABLES}, "credit_applications_entity_audit": audit}


_APPLICATION_TABLES = (
    "credit_applications_entity",
    "credit_application_meta_data",
    "borrower_accounts",
    "partner_accounts",
    "platform_accounts",
    "credit_main",
)


@query(
    "e1_latest_row_stored",
    """select l_orderkey, l_shipdate, l_partkey, l_quantity from (select l_orderkey, l_shipdate, l_partkey, l_quantity,
       row_number() over (partition by l_orderkey order by l_shipdate desc nulls first, l_partkey, l_quantity) as rn from
       (select nullif(l_orderkey % 5000, 3) as l_orderkey, case when l_partkey % 10 > 0 then l_shipdate end as l_shipdate, l_partkey, l_quantity
        from lineitem)) where rn = 1""",
)
def _(t):
    rows = t["lineitem"].select(
        F.expr("nullif(l_orderkey % 5000, 3)").alias("l_orderkey"),
        F.when(F.col("l_partkey") % 10 > 0, F.col("l_shipdate")).alias("l_shipdate"),
        "l_partkey",
        "l_quantity",
    )
    return keyed(rows, "l_orderkey", "l_shipdate").by_key(lambda h: history.latest_row(h, ["l_orderkey"], "l_shipdate"))


@query(
    "c8_next_after_stored",
    """with e as (select if(event_id % 3 = 0, 7, user_id) as user_id, event_type, ts from events)
       select e.user_id, min(e.ts) as next_on from e join (select user_id, max(ts) as last from e where event_type = 'click' group by 1) c
       on c.user_id = e.user_id where e.event_type = 'purchase' and e.ts > c.last - interval 1 day group by 1""",
)
def _(t):
    """A third of the history on one key. The clicks are dated back, so that more purchases come later."""
    rows = t["events"].select(
        F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(F.col("event_type") == "click", F.col("ts") - F.expr("interval 1 day")).otherwise(F.col("ts")).alias("ts"),
    )
    return keyed(rows, "user_id", "ts").by_key(lambda h: history.next_after(h, "user_id", "event_type", "ts", "click", "purchase"))


@query("j20_facts_fetch_step_stored", FETCHED)
def _(t):
    return journey.application_facts(with_keyed_audit(t), PLATFORMS, FETCH_STEP)


@query("j21_facts_pledge_step_stored", PLEDGED)
def _(t):
    return journey.application_facts(with_keyed_audit(t), PLATFORMS, PLEDGE_STEP)


@query("j42_effective_once_stored", EFFECTIVE_ONCE)
def _(t):
    return partners.effective_applications(with_keyed_audit(t), dedupe_history=True)


@query("j43_completion_dates_stored", DATES)
def _(t):
    return partners.completion_dates(with_keyed_audit(t), HISTORY_START, EXCLUDED)


def dated(t: Mapping[str, DataFrame], moments: Mapping[str, str]) -> Mapping[str, DataFrame]:
    """The tables of ``moments`` stored by month and opened for the cubes' look-back; the others as they are."""
    top = f"{checkpoint_folder(t['orders'].sparkSession)}/dated-{uuid4().hex}"
    for name, moment in moments.items():
        stores.write_dated(t[name], f"{top}/{name}", moment, "month")
    opened = stores.from_dated(t["orders"].sparkSession, {n: f"{top}/{n}" for n in moments}, RECENT_AS_OF, sla.LOOKBACK_DAYS, unit="month")
    return t | opened


@query("j01_withdrawals_dated", RECENT_CUBES["j01_withdrawals"])
def _(t):
    return sla.withdrawals(dated(t, {"disbursals": "requested_on"}), RECENT_AS_OF)


@query("j02_repayments_dated", RECENT_CUBES["j02_repayments"])
def _(t):
    return sla.repayments(dated(t, {"collections": sla.REPAYMENT.start}), RECENT_AS_OF)


@query("j05_account_opening_dated", RECENT_CUBES["j05_account_opening"])
def _(t):
    return sla.account_openings(dated(t, {"credit_main": "created_on"}), TERMS, RECENT_AS_OF)
