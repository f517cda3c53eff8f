"""Partner payouts against the partner master, and the partner activation scorecard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.functions.rules import bracketed, safe_ratio, trimmed
from loanops.functions.timekit import instant, month_gap, month_start, to_business_time, trunc, whole_days
from loanops.operators.history import next_after
from loanops.operators.joins import HOT_PARTS, Dimension, left_dims, per_key, spread_join
from loanops.sources.stores import by_key, whole

# ---------------------------------------------------------------- payouts


def payment_spans(payouts: DataFrame) -> DataFrame:
    """First and last payment per partner and credited account."""
    return (
        payouts.filter(F.col("payment_date").isNotNull())
        .groupBy(F.col("destination_id").alias("partner_account_id"), "credit_account_number")
        .agg(F.min("payment_date").alias("first_payment_date"), F.max("payment_date").alias("last_payment_date"))
    )


def partner_status(t: Mapping[str, DataFrame]) -> DataFrame:
    """Partners with the business date of their first credit; without one they are only empanelled."""
    first = t["credit_main"].groupBy("partner_account_id").agg(F.min("created_on").alias("first_on"))
    partners = t["partner_accounts"].select(
        F.col("account_id").alias("partner_account_id"), "partner_name", "bank_account_number", "bank_accountifsccode"
    )
    joined = left_dims(partners, [Dimension(first, "partner_account_id", "partner_account_id", {"first_on": "first_on"})])
    activated = F.to_date(to_business_time(F.col("first_on")))
    return joined.select(
        *partners.columns,
        activated.alias("activation_date"),
        F.when(activated.isNull(), "empanelled").otherwise("activated").alias("account_status"),
    )


def partner_payout_check(t: Mapping[str, DataFrame], hot_parts: int = HOT_PARTS) -> DataFrame:
    """Payment spans and partner master in full outer join; the account number trimmed and bracketed."""
    spans = payment_spans(t["payout_transactions"])
    master = partner_status(t).withColumnRenamed("partner_account_id", "__partner")
    paid = t["payout_transactions"].filter(F.col("payment_date").isNotNull())
    both = spread_join(
        spans,
        master,
        ["partner_account_id"],
        ["__partner"],
        "full",
        hot="left",
        left_keys=paid.select(F.col("destination_id").alias("partner_account_id")),
        hot_parts=hot_parts,
    )
    return both.withColumns(
        {
            "partner_account_id": F.coalesce("partner_account_id", "__partner"),
            "bank_account_number": bracketed(trimmed(F.col("bank_account_number"))),
        }
    ).drop("__partner")


# ---------------------------------------------------------------- scorecard

# Where a completion date comes from.
DEFAULTED = "DEFAULTED DATE"
OWN_DATE = "COMPLETED_ON AVAILABLE"
FROM_HISTORY = "AUDIT_TABLE AVAILABLE"
BEFORE_HISTORY = "ENHANCEMENT BEFORE AUDIT TABLE"
FIRST_CREDIT = "FIRST APPLICATION BEFORE AUDIT TABLE"

_ENTITY_COLUMNS = (
    "lender_account_id",
    "application_id",
    "account_id",
    "partner_account_id",
    "platform_account_id",
    "application_type",
    "current_step_id",
    "application_state",
    "last_updated_on",
    "created_on",
    "completed_on",
)


def _weighted_applications(t: Mapping[str, DataFrame], dedupe_history: bool) -> DataFrame:
    """Finished applications, one row each, with ``copies``: how often the history repeats it.

    A SUSPENDED application with a COMPLETED history row counts as completed. The original plan joins the
    history rows as they are, so an application appears once per COMPLETED row. Here that is a number, which
    later sums multiply by; nothing is copied.
    """
    done = F.col("application_state") == C.COMPLETED
    times = by_key(
        t["credit_applications_entity_audit"],
        lambda history: history.filter(done).groupBy("application_id").agg(F.count("*").alias("completed_rows")),
    )
    rows = t["credit_applications_entity"].filter(F.col("application_state").isin(C.COMPLETED, C.SUSPENDED))
    found = Dimension(times, "application_id", "application_id", {"completed_rows": "completed_rows"})
    joined = left_dims(rows.select(*_ENTITY_COLUMNS), [found])
    repaired = F.when(
        (F.col("application_state") == C.SUSPENDED) & F.col("completed_rows").isNotNull(), C.COMPLETED
    ).otherwise(F.col("application_state"))
    copies = F.lit(1).cast("long") if dedupe_history else F.coalesce("completed_rows", F.lit(1))
    return joined.withColumns({"application_state": repaired, "copies": copies}).drop("completed_rows")


def effective_applications(
    t: Mapping[str, DataFrame], dedupe_history: bool = False, hot_parts: int = HOT_PARTS
) -> DataFrame:
    """Finished applications with their effective state; by default once per COMPLETED history row."""
    rows = _weighted_applications(t, dedupe_history=True).drop("copies").withColumn("date_source", F.lit(DEFAULTED))
    if dedupe_history:
        return rows
    done = whole(t["credit_applications_entity_audit"]).filter(F.col("application_state") == C.COMPLETED)
    side = done.select(F.col("application_id").alias("__app"))
    return spread_join(rows, side, ["application_id"], ["__app"], "left", hot="right", hot_parts=hot_parts).drop("__app")


def _dated_applications(
    t: Mapping[str, DataFrame],
    history_start: datetime | str,
    exclude_ids: Sequence[object],
    dedupe_history: bool,
) -> DataFrame:
    """Weighted applications with ``dates``: all completion dates that apply, each with its source.

    The four sources are tests on the same application row, so one pass replaces a union that reads the
    applications four times and joins the result back. Application ids are unique in the entity table.
    """
    cutoff = instant(history_start)
    rows = _weighted_applications(t, dedupe_history)
    moved = by_key(
        t["credit_applications_entity_audit"],
        lambda history: next_after(
            history, "application_id", "application_state", "last_updated_on", C.IN_PROGRESS, C.COMPLETED, "moved_on"
        ),
    )
    rows = left_dims(rows, [Dimension(moved, "application_id", "application_id", {"moved_on": "moved_on"})])
    first = per_key(t["credit_main"].filter(F.col("created_on") < cutoff), ["account_id"], F.min("created_on").alias("first_credit_on"))
    rows = left_dims(rows, [Dimension(first, "account_id", "account_id", {"first_credit_on": "first_credit_on"})])
    completed = F.col("application_state") == C.COMPLETED
    undated = completed & F.col("completed_on").isNull()
    borrower = F.col("application_type") == C.BORROWER_TYPE
    allowed = ~F.col("application_id").isin(*exclude_ids) if exclude_ids else F.lit(True)

    def source(test: Column, moment: str, tag: str) -> Column:
        return F.when(test, F.struct(F.col(moment).alias("completed_on"), F.lit(tag).alias("date_source")))

    updated = F.col("last_updated_on")
    dates = F.array(
        source(completed & F.col("completed_on").isNotNull() & (updated >= cutoff), "completed_on", OWN_DATE),
        source(undated & F.col("moved_on").isNotNull(), "moved_on", FROM_HISTORY),
        source(completed & ~borrower & (updated < cutoff), "last_updated_on", BEFORE_HISTORY),
        source(undated & borrower & allowed & (F.col("created_on") < F.col("first_credit_on")), "first_credit_on", FIRST_CREDIT),
    )
    return rows.withColumn("dates", F.filter(dates, lambda d: d.isNotNull())).drop("moved_on", "first_credit_on")


def completion_dates(
    t: Mapping[str, DataFrame],
    history_start: datetime | str,
    exclude_ids: Sequence[object] = (),
) -> DataFrame:
    """Completion dates by source. An application may have several, each with its own tag."""
    rows = _dated_applications(t, history_start, exclude_ids, True)
    return rows.select("application_id", F.explode("dates").alias("d")).select(
        "application_id", "d.completed_on", "d.date_source"
    )


def _weighted_credits(t, history_start, exclude_ids, dedupe_history) -> DataFrame:
    rows = _dated_applications(t, history_start, exclude_ids, dedupe_history)
    rows = rows.filter((F.col("application_state") == C.COMPLETED) & F.col("partner_account_id").isNotNull())
    limits = Dimension(
        t["credit_application_meta_data"],
        "application_id",
        "application_id",
        {"eligible_credit_limit": "eligible_credit_limit", "pledged_credit_limit": "pledged_credit_limit"},
    )
    partner = Dimension(
        t["partner_accounts"], "partner_account_id", "account_id", {"partner_account_type": "partner_account_type"}
    )
    platform = Dimension(t["platform_accounts"], "platform_account_id", "account_id", {"platform_name": "platform_name"})
    named = left_dims(rows, [limits, partner, platform]).withColumn("d", F.explode_outer("dates"))
    return named.select(
        "lender_account_id",
        "platform_name",
        "partner_account_id",
        "partner_account_type",
        "account_id",
        "application_id",
        "application_type",
        F.lit(C.COMPLETED).alias("current_step_id"),
        F.lit(C.COMPLETED).alias("application_state"),
        "eligible_credit_limit",
        "pledged_credit_limit",
        F.coalesce("d.date_source", F.lit(DEFAULTED)).alias("data_source"),
        to_business_time(F.coalesce("d.completed_on", "completed_on")).alias("current_step_started_on"),
        "copies",
    )


def completed_credits(
    t: Mapping[str, DataFrame],
    history_start: datetime | str,
    exclude_ids: Sequence[object] = (),
    dedupe_history: bool = False,
    expand: bool = True,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """Completed applications of partners with limits, names and business completion time.

    ``expand`` False keeps one row per application and date with its number of ``copies``: the scorecard
    reports take that form and give the same figures.
    """
    if dedupe_history or not expand:
        return _weighted_credits(t, history_start, exclude_ids, dedupe_history)
    rows = _weighted_credits(t, history_start, exclude_ids, True).drop("copies")
    done = whole(t["credit_applications_entity_audit"]).filter(F.col("application_state") == C.COMPLETED)
    side = done.select(F.col("application_id").alias("__app"))
    return spread_join(rows, side, ["application_id"], ["__app"], "left", hot="right", hot_parts=hot_parts).drop("__app")


def _copies(credits: DataFrame) -> Column:
    return F.col("copies") if "copies" in credits.columns else F.lit(1)


def _money(column: Column) -> Column:
    """Sums of money times a count stay decimals with two places."""
    return column.cast("decimal(38,2)")


def partner_history(credits: DataFrame, as_of) -> DataFrame:
    """Per partner, everything up to the end of the month two months before ``as_of``."""
    started, limit, copies = F.col("current_step_started_on"), F.col("pledged_credit_limit"), _copies(credits)
    customer = (F.col("application_type") == C.BORROWER_TYPE) & F.col("application_id").isNotNull()
    return (
        credits.filter(started < instant(month_start(as_of, 1)))
        .groupBy("partner_account_id")
        .agg(
            F.min(started).alias("partner_activated_on"),
            F.max(started).alias("partner_last_app_date"),
            F.max(limit).alias("max_pledged_credit_limit"),
            _money(F.sum(limit * copies)).alias("sum_pledged_credit_limit"),
            F.coalesce(F.sum(F.when(customer, copies)), F.lit(0)).cast("long").alias("total_customers"),
        )
        .withColumns(
            {
                "previous_month": instant(month_start(as_of, 2)),
                "partner_activated_month": trunc("month", F.col("partner_activated_on")),
                "partner_last_app_month": trunc("month", F.col("partner_last_app_date")),
            }
        )
    )


def partner_classes(history: DataFrame, as_of, *more: str) -> DataFrame:
    """Customers per month and the two partner groups: size (gold / rest / recent) and activity (churn / active); ``more`` columns stay."""
    first = month_start(as_of)
    reference = instant(first - timedelta(days=31))
    months = month_gap(F.col("previous_month"), F.col("partner_activated_month"))
    pace = safe_ratio(F.col("total_customers"), months)
    idle = whole_days(reference, F.col("partner_last_app_date"))
    gold = (
        (F.col("sum_pledged_credit_limit") >= C.GOLD_SUM)
        & (F.col("total_customers") >= C.GOLD_CUSTOMERS)
        & (F.col("max_pledged_credit_limit") >= C.GOLD_MAX)
        & (pace >= C.GOLD_CUSTOMERS_PER_MONTH)
    )
    return history.select(
        "partner_account_id",
        "partner_activated_on",
        "partner_activated_month",
        "partner_last_app_date",
        "partner_last_app_month",
        "max_pledged_credit_limit",
        "sum_pledged_credit_limit",
        "total_customers",
        months.alias("month_count"),
        pace.alias("average_customer_per_month"),
        F.when(whole_days(reference, F.col("partner_activated_on")) < C.RECENT_DAYS, "Activations < 45 days")
        .when(gold, "GOLD")
        .otherwise("REST")
        .alias("mfd_group_1"),
        whole_days(instant(first - timedelta(days=1)), F.col("partner_last_app_month")).alias("days_diff"),
        F.when(idle > C.RECENT_DAYS, "CHURN").when(idle <= C.RECENT_DAYS, "ACTIVE").alias("mfd_group_2"),
        *more,
    )


def partner_last_month(credits: DataFrame, as_of) -> DataFrame:
    """Per partner, the month before ``as_of``: distinct applications by kind, and pledged limits.

    Renewals count as existing applications too. Rows are reduced to one per application first, so distinct
    counts need no copies of the rows.
    """
    started, limit, copies = F.col("current_step_started_on"), F.col("pledged_credit_limit"), _copies(credits)
    kind = F.col("application_type")
    new, renewal = kind == C.BORROWER_TYPE, kind == C.RENEWAL_TYPE
    kinds = {"new": new, "renewal": renewal, "existing": kind != C.BORROWER_TYPE}
    per_application = (
        credits.filter((started >= instant(month_start(as_of, 1))) & (started < instant(month_start(as_of))))
        .groupBy("partner_account_id", "application_id")
        .agg(
            F.min(started).alias("first_on"),
            F.max(started).alias("last_on"),
            F.sum(limit * copies).alias("pledged"),
            F.sum(F.when(new, limit * copies)).alias("pledged_new"),
            F.sum(F.when(renewal, limit * copies)).alias("pledged_renewal"),
            *[F.bool_or(F.coalesce(test, F.lit(False))).alias(f"is_{name}") for name, test in kinds.items()],
        )
    )
    named = F.col("application_id").isNotNull()
    return per_application.groupBy("partner_account_id").agg(
        F.min("first_on").alias("partner_activated_on"),
        F.max("last_on").alias("partner_last_app_date"),
        _money(F.sum("pledged")).alias("sum_pledged_credit_limit"),
        F.count_if(named).alias("applications"),
        *[F.count_if(named & F.col(f"is_{name}")).alias(f"total_{name}_applications") for name in kinds],
        _money(F.sum("pledged_new")).alias("total_new_pledged_limits"),
        _money(F.sum("pledged_renewal")).alias("total_renewal_pledged_limits"),
    )


def partner_periods(credits: DataFrame, as_of) -> DataFrame:
    """Both periods in one pass over the credits: the columns of ``partner_history``, and of ``partner_last_month`` as ``now_*``.

    A partner without rows in a period has nulls there.
    """
    started, limit, copies = F.col("current_step_started_on"), F.col("pledged_credit_limit"), _copies(credits)
    kind = F.col("application_type")
    earlier = started < instant(month_start(as_of, 1))
    now = (started >= instant(month_start(as_of, 1))) & (started < instant(month_start(as_of)))
    new, renewal = kind == C.BORROWER_TYPE, kind == C.RENEWAL_TYPE
    kinds = {"new": new, "renewal": renewal, "existing": kind != C.BORROWER_TYPE}
    pledged = limit * copies
    named = F.col("application_id").isNotNull()
    per_application = (
        credits.filter(started < instant(month_start(as_of)))
        .groupBy("partner_account_id", "application_id")
        .agg(
            F.min(F.when(earlier, started)).alias("then_first"),
            F.max(F.when(earlier, started)).alias("then_last"),
            F.max(F.when(earlier, limit)).alias("then_limit"),
            F.sum(F.when(earlier, pledged)).alias("then_pledged"),
            F.sum(F.when(earlier & new, copies)).alias("then_customers"),
            F.min(F.when(now, started)).alias("now_first"),
            F.max(F.when(now, started)).alias("now_last"),
            F.sum(F.when(now, pledged)).alias("now_pledged"),
            F.sum(F.when(now & new, pledged)).alias("now_pledged_new"),
            F.sum(F.when(now & renewal, pledged)).alias("now_pledged_renewal"),
            *[F.bool_or(F.coalesce(now & test, F.lit(False))).alias(f"is_{name}") for name, test in kinds.items()],
        )
    )
    seen_now, seen_then = F.max("now_first").isNotNull(), F.max("then_first").isNotNull()
    present = named & F.col("now_first").isNotNull()
    return (
        per_application.groupBy("partner_account_id")
        .agg(
            F.min("then_first").alias("partner_activated_on"),
            F.max("then_last").alias("partner_last_app_date"),
            F.max("then_limit").alias("max_pledged_credit_limit"),
            _money(F.sum("then_pledged")).alias("sum_pledged_credit_limit"),
            F.when(seen_then, F.coalesce(F.sum(F.when(named, F.col("then_customers"))), F.lit(0))).cast("long").alias("total_customers"),
            F.min("now_first").alias("now_activated_on"),
            F.max("now_last").alias("now_last_app_date"),
            _money(F.sum("now_pledged")).alias("now_sum_pledged_credit_limit"),
            F.when(seen_now, F.count_if(present)).alias("now_applications"),
            *[F.when(seen_now, F.count_if(present & F.col(f"is_{name}"))).alias(f"now_{name}_applications") for name in kinds],
            _money(F.sum("now_pledged_new")).alias("now_new_pledged_limits"),
            _money(F.sum("now_pledged_renewal")).alias("now_renewal_pledged_limits"),
        )
        .withColumns(
            {
                "previous_month": instant(month_start(as_of, 2)),
                "partner_activated_month": trunc("month", F.col("partner_activated_on")),
                "partner_last_app_month": trunc("month", F.col("partner_last_app_date")),
            }
        )
    )


def partner_scorecard(
    t: Mapping[str, DataFrame],
    history_start: datetime | str,
    as_of,
    exclude_ids: Sequence[object] = (),
    dedupe_history: bool = False,
) -> DataFrame:
    """Last month against the classes of all earlier months, full outer; no history means a new partner."""
    credits = completed_credits(t, history_start, exclude_ids, dedupe_history, expand=False)
    return scorecard(partner_periods(credits, as_of), as_of)


def scorecard(periods: DataFrame, as_of) -> DataFrame:
    both = partner_classes(periods, as_of, *[c for c in periods.columns if c.startswith("now_")])
    fresh = F.col("partner_activated_on").isNull()
    return both.select(
        "partner_account_id",
        F.coalesce("partner_activated_on", "now_activated_on").alias("partner_activated_on"),
        F.coalesce("partner_last_app_date", "now_last_app_date").alias("partner_last_app_date"),
        F.when(fresh, "New MFD").otherwise(F.col("mfd_group_1")).alias("mfd_group_1"),
        F.when(fresh, "New MFD").otherwise(F.col("mfd_group_2")).alias("mfd_group_2"),
        "average_customer_per_month",
        F.col("total_customers").alias("prev_total_customers"),
        F.col("sum_pledged_credit_limit").alias("prev_sum_pledged_credit_limit"),
        F.col("max_pledged_credit_limit").alias("prev_max_pledged_credit_limit"),
        F.when(F.col("now_applications") > 0, "case done").otherwise("case not done").alias("case_done_flag"),
        F.col("now_applications").alias("current_applications"),
        F.col("now_new_applications").alias("current_new_applications"),
        F.col("now_renewal_applications").alias("current_renewal_applications"),
        F.col("now_existing_applications").alias("current_existing_applications"),
        F.col("now_new_pledged_limits").alias("current_new_pledged_limits"),
        F.col("now_renewal_pledged_limits").alias("current_renewal_pledged_limits"),
        F.col("now_sum_pledged_credit_limit").alias("current_sum_pledged_credit_limit"),
    )
