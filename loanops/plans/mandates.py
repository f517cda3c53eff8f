"""Mandate registrations: recent events, daily summary, and small look-ups.

The summary follows the intent of its source text, which does not parse: grouped by day, week and month,
with the mandate status as the only status and no channel columns.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.constants import BUSINESS_OFFSET
from loanops.functions.rules import json_text
from loanops.functions.timekit import instant, midnight, to_business_time, trunc
from loanops.operators.aggregates import distinct_counts
from loanops.operators.bitmaps import distinct_state, merged_counts

# Mandate states.
FINISHED = "Finished"
FAILED = "Failed"
RUNNING = "In Progress"


def mandate_events(mandates: DataFrame, as_of, days: int = 6, request_field: str = "mandate_request_id") -> DataFrame:
    """Mandate rows whose business date is later than the business start of the day ``days`` days ago.

    That start is 05:30, and dates count from midnight, so the first full date is ``days - 1`` days ago.
    """
    created = F.col("created_date_time").cast("timestamp_ntz")
    first_date = midnight(as_of) - timedelta(days=days - 1)
    return mandates.filter(created >= instant(first_date - BUSINESS_OFFSET)).select(
        "application_id",
        to_business_time(created).alias("created_date_time"),
        "bank_account_number",
        "bank_ifsc_code",
        "mandate_status",
        json_text(F.col("save_mandate_request"), request_field).alias("mandate_request_id"),
        json_text(F.col("mandate_data"), "emandate_error_message").alias("emandate_error_message"),
        json_text(F.col("mandate_data"), "emandate_status").alias("emandate_status"),
    )


def _summary_counts(request: str, application: str) -> dict:
    status = F.col("mandate_status")
    return {
        "total_mandate_attempts_events": (request, None),
        "total_mandate_success_events": (request, status == FINISHED),
        "total_mandate_failed_events": (request, status == FAILED),
        "total_applications_attempts": (application, None),
        "total_applications_success_attempts": (application, status == FINISHED),
        "total_applications_failed_attempts": (application, status == FAILED),
    }


def mandate_summary(events: DataFrame, lender: str) -> DataFrame:
    """Per day: distinct requests and applications, all, successful and failed."""
    created = F.col("created_date_time")
    dated = events.select(
        F.to_date(created).alias("date"),
        trunc("week", created).alias("week_start"),
        trunc("month", created).alias("month_start"),
        "mandate_request_id",
        "application_id",
        "mandate_status",
    )
    counts = distinct_counts(dated, ["date", "week_start", "month_start"], _summary_counts("mandate_request_id", "application_id"))
    return counts.select(F.lit(lender).alias("lender"), *counts.columns)


def mandate_rollup(events: DataFrame, lender: str, request: str = "mandate_request_id", application: str = "application_id") -> DataFrame:
    """The same counts per day, per week and per month (``unit`` D, W, M), all from one pass: the days' bitmaps make those of weeks and months.

    ``request`` and ``application``: columns of whole-numbered ids that lie close together.
    """
    counts = _summary_counts(request, application)
    state = distinct_state(events.withColumn("date", F.to_date("created_date_time")), ["date"], counts)
    periods = F.array(
        *[
            F.struct(F.lit(unit).alias("unit"), start.alias("start"))
            for unit, start in (("D", F.col("date")), ("W", F.trunc("date", "week")), ("M", F.trunc("date", "month")))
        ]
    )
    rows = state.withColumn("period", F.explode(periods)).select("period.*", *[c for c in state.columns if c != "date"])
    found = merged_counts(rows, ["unit", "start"], list(counts))
    return found.select(F.lit(lender).alias("lender"), *found.columns)


def status_counts(mandates: DataFrame) -> DataFrame:
    return mandates.groupBy("mandate_status").agg(F.count("*").alias("count"))


def application_counts(mandates: DataFrame) -> DataFrame:
    """Per application, its rows in progress and finished; rows without application count nothing."""
    named = F.col("application_id").isNotNull()
    return mandates.groupBy("application_id").agg(
        F.count_if(named & (F.col("mandate_status") == RUNNING)).alias("inprogress"),
        F.count_if(named & (F.col("mandate_status") == FINISHED)).alias("finished"),
    )


def application_record(mandates: DataFrame, application_id, request_field: str = "mandate_request_id") -> DataFrame:
    return mandates.filter(F.col("application_id") == application_id).select(
        "application_id",
        json_text(F.col("save_mandate_request"), request_field).alias("mandate_request_id"),
        "mandate_status",
        "last_updated_on",
        "save_mandate_request",
        "save_mandate_response",
    )
