"""One platform's lead funnel: first leads against borrower applications."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.functions.timekit import day, to_business_time
from loanops.operators.aggregates import flag_any
from loanops.operators.history import group_max_rows, with_group_min
from loanops.operators.joins import HOT_PARTS, Dimension, left_dims, spread_join
from loanops.plans.journey import APPLICATION_LIMITS, leads_at, person_extremes, persons_of, portfolio_persons

# Columns of the funnel, in published order.
FUNNEL_COLUMNS = (
    "account_holderpan",
    "account_holder_phone_number",
    "application_id",
    "created_on",
    "current_step_id",
    "completed_on",
    "cams_fetched",
    "karvy_fetched",
    "mfc_eligible_credit_limit",
    "app_eligible_credit_limit",
    "app_pledged_credit_limit",
    "email_address",
    "mf_count",
    "request_id",
    "platform_name",
    "mfc_created_on",
    "app_created_on",
    "email_status",
)
# Fixed value: step shown for a lead that has no application yet.
FETCHED_ONLY = "MFC Fetched"
_LEAD = "lead__"


def _names(t: Mapping[str, DataFrame]) -> list[Dimension]:
    return [
        Dimension(
            t["partner_accounts"],
            "partner_account_id",
            "account_id",
            {"partner_name": "partner_name", "partner_account_type": "partner_account_type"},
        ),
        Dimension(t["platform_accounts"], "platform_account_id", "account_id", {"platform_name": "platform_name"}),
    ]


def asset_flags(fetches: DataFrame) -> DataFrame:
    """Per application: was each register fetched, 'Y' or 'N'."""
    register = F.col("asset_repository")
    return fetches.groupBy("application_id").agg(
        flag_any(register == "CAMS").alias("cams_fetched"), flag_any(register == "KARVY").alias("karvy_fetched")
    )


def fund_counts(pledges: DataFrame) -> DataFrame:
    return pledges.groupBy("application_id").agg(F.count("isin_no").alias("mf_count"))


def application_funnel(t: Mapping[str, DataFrame], house_name: str = "HOUSE") -> DataFrame:
    """Borrower applications of persons with a PAN, with the account's first application date and asset facts."""
    borrower_type = t["credit_applications_entity"].filter(F.col("application_type") == C.BORROWER_TYPE)
    rows = with_group_min(borrower_type, ["account_id"], "created_on", "app_created_on")
    limits = Dimension(t["credit_application_meta_data"], "application_id", "application_id", APPLICATION_LIMITS)
    flags = Dimension(
        asset_flags(t["asset_fetch_data"]),
        "application_id",
        "application_id",
        {"cams_fetched": "cams_fetched", "karvy_fetched": "karvy_fetched"},
    )
    funds = Dimension(fund_counts(t["asset_pledge_data"]), "application_id", "application_id", {"mf_count": "mf_count"})
    borrower = Dimension(
        t["borrower_accounts"].filter(F.col("account_holderpan").isNotNull()),
        "account_id",
        "account_id",
        {
            "app_pan": "account_holderpan",
            "app_phone_number": "account_holder_phone_number",
            "account_holder_name": "account_holder_name",
            "account_holder_email": "account_holder_email",
        },
    )
    joined = left_dims(rows, [limits, flags, funds, borrower, *_names(t)]).filter(F.col("app_pan").isNotNull())
    return joined.select(
        "application_id",
        "app_pan",
        "app_phone_number",
        *APPLICATION_LIMITS,
        F.coalesce("current_step_id", F.lit(C.COMPLETED)).alias("current_step_id"),
        F.col("last_updated_on").alias("app_last_updated_on"),
        "platform_account_id",
        "partner_account_id",
        "partner_account_type",
        F.coalesce("platform_name", F.lit(house_name)).alias("platform_name"),
        "partner_name",
        "application_state",
        "completed_on",
        "app_created_on",
        "lender_account_id",
        "account_holder_name",
        "application_type",
        "cams_fetched",
        "karvy_fetched",
        "account_holder_email",
        "mf_count",
    )


# Fixed value: kind of the messages whose status is shown.
MESSAGE_KIND = "EMAIL"


def latest_message_status(messages: DataFrame, kind: str = MESSAGE_KIND) -> DataFrame:
    """Each recipient's latest message records of one kind, ties kept."""
    wanted = messages.filter(F.col("message_type") == kind).select(
        "message_type", "primary_recipient", "record_created_on", "record_last_updated_on", F.col("status").alias("email_status")
    )
    return group_max_rows(wanted, ["primary_recipient"], "record_last_updated_on")


def platform_leads(t: Mapping[str, DataFrame], platform_id) -> DataFrame:
    """Leads of one platform."""
    leads = t["customer_leads"].filter(F.col("platform_account_id") == platform_id)
    return leads.select(
        "lead_id",
        "pan",
        "partner_account_id",
        "platform_account_id",
        F.col("phone_number").alias("mfc_phone_number"),
        F.col("created_date_time").alias("mfc_created_on"),
        "full_name",
        "email_id",
        "request_id",
    )


def platform_lead_funnel(
    t: Mapping[str, DataFrame],
    portfolio: DataFrame,
    platform_id,
    start: date | str,
    house_name: str = "HOUSE",
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """First leads of one platform in full outer join with all borrower applications, from ``start`` on.

    Kept are rows where either side belongs to the platform; dates are shown in business time.
    """
    leads = platform_leads(t, platform_id)
    messages = latest_message_status(t["communication_message_records"])
    best = person_extremes(leads, portfolio, "created_on", "min")
    # A recipient with a message of the kind that has a time has a latest one.
    recipients = t["communication_message_records"].filter((F.col("message_type") == MESSAGE_KIND) & F.col("record_last_updated_on").isNotNull())
    first = spread_join(
        left_dims(leads_at(leads, portfolio, best, "created_on", hot_parts), _names(t)),
        messages,
        ["email_id"],
        ["primary_recipient"],
        "left",
        hot="right",
        right_keys=recipients.select("primary_recipient"),
        hot_parts=hot_parts,
    )
    first = first.withColumnsRenamed({c: _LEAD + c for c in first.columns})
    # Cheaper tables with the same persons on either side, to find hot ones.
    applications = t["credit_applications_entity"].filter(F.col("application_type") == C.BORROWER_TYPE)
    both = spread_join(
        application_funnel(t, house_name),
        first,
        ["app_pan"],
        [_LEAD + "pan"],
        "full",
        left_keys=persons_of(t, applications),
        right_keys=portfolio_persons(leads, portfolio).withColumnRenamed("pan", _LEAD + "pan"),
        hot_parts=hot_parts,
    )

    def lead(name: str) -> Column:
        return F.col(_LEAD + name)

    own = (F.col("platform_account_id") == platform_id) | (lead("platform_account_id") == platform_id)
    earlier = (F.col("platform_account_id") == lead("platform_account_id")) & (
        F.col("app_created_on") < lead("mfc_created_on")
    )
    created = F.when(earlier | lead("mfc_created_on").isNull(), F.col("app_created_on")).otherwise(lead("mfc_created_on"))
    rows = both.filter(own).select(
        F.coalesce(lead("pan"), "app_pan").alias("account_holderpan"),
        F.coalesce("app_phone_number", lead("mfc_phone_number")).alias("account_holder_phone_number"),
        "application_id",
        F.to_date(to_business_time(created)).alias("created_on"),
        F.when(F.col("application_id").isNull() & F.col("current_step_id").isNull(), FETCHED_ONLY)
        .otherwise(F.col("current_step_id"))
        .alias("current_step_id"),
        F.to_date(to_business_time(F.col("completed_on"))).alias("completed_on"),
        "cams_fetched",
        "karvy_fetched",
        lead("mfc_eligible_credit_limit").alias("mfc_eligible_credit_limit"),
        "app_eligible_credit_limit",
        "app_pledged_credit_limit",
        F.coalesce(lead("email_id"), "account_holder_email").alias("email_address"),
        "mf_count",
        lead("request_id").alias("request_id"),
        F.coalesce("platform_name", lead("platform_name")).alias("platform_name"),
        lead("mfc_created_on").alias("mfc_created_on"),
        "app_created_on",
        lead("email_status").alias("email_status"),
    )
    return rows.filter((F.col("created_on") >= day(start)) | (F.col("completed_on") >= day(start))).select(*FUNNEL_COLUMNS)
