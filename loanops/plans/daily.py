"""Daily extracts: foreclosures of a business day with their collections, and repayments of a day."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.constants import BUSINESS_OFFSET
from loanops.functions.rules import json_text
from loanops.functions.timekit import business_day_window, midnight, on_day_or_late, to_business_time
from loanops.operators.joins import Dimension, left_dims

# Display names of the foreclosure extract.
FORECLOSURE_DISPLAY = {
    "collection_id": "Collection ID",
    "account_holderpan": "Customer Pan",
    "account_holder_name": "Customer Name",
    "request_id": "Request ID",
    "lender_loan_account_number": "Lender Loan Account Number",
    "lender_credit_id": "Lender Credit ID",
    "status": "Status",
    "created_on": "Created_on",
    "last_updated_on": "Last Updated On",
    "lender_id": "Lender",
    "credit_id": "Credit ID",
    "amount_due": "Amount Due",
    "actual_amount_collected": "Amount Collected",
    "transaction_id": "Transaction ID",
    "callback_received_on": "Callback Received On",
}
# Fields of the payment gateway's answer.
PAYMENT_FIELDS = {
    "bank_ref_no": "bankRefNo",
    "payment_mode": "paymentMode",
    "pg_tracking_id": "pgTrackingId",
    "status_message": "statusMessage",
}


def _borrower(t: Mapping[str, DataFrame], *columns: str) -> Dimension:
    return Dimension(t["borrower_accounts"], "account_id", "account_id", {c: c for c in columns})


def foreclosures_of_day(
    t: Mapping[str, DataFrame],
    as_of,
    cutoff: timedelta = timedelta(hours=12, minutes=30),
    offset: timedelta = BUSINESS_OFFSET,
) -> DataFrame:
    """Foreclosure requests created strictly between yesterday's and today's cutoff, in business time."""
    rows = t["foreclosure_requests"].filter(business_day_window(F.col("created_on"), as_of, cutoff, offset))
    loan = Dimension(
        t["credit_main"],
        "credit_id",
        "credit_id",
        {"lender_loan_account_number": "lender_loan_account_number", "lender_credit_id": "lender_credit_id"},
    )
    return left_dims(rows, [loan, _borrower(t, "account_holderpan", "account_holder_name")]).select(
        F.col("associated_collection_id").alias("collection_id"),
        "account_holderpan",
        "account_holder_name",
        "request_id",
        "lender_loan_account_number",
        "lender_credit_id",
        "status",
        to_business_time(F.col("created_on"), offset).alias("created_on"),
        to_business_time(F.col("last_updated_on"), offset).alias("last_updated_on"),
        "lender_id",
        "credit_id",
        "amount_due",
    )


def foreclosure_collections(
    t: Mapping[str, DataFrame], as_of, display: bool = False, offset: timedelta = BUSINESS_OFFSET, **window
) -> DataFrame:
    """The day's foreclosures with the collections that they name."""
    requests = foreclosures_of_day(t, as_of, offset=offset, **window)
    received = to_business_time(F.coalesce("callback_received_on", "last_updated_on"), offset)
    side = t["collections"].select("collection_id", "actual_amount_collected", "transaction_id", received.alias("callback_received_on"))
    joined = requests.join(side, "collection_id", "left").select(*FORECLOSURE_DISPLAY)
    return joined.withColumnsRenamed(FORECLOSURE_DISPLAY) if display else joined


def by_lender(extract: DataFrame, lenders, column: str = "lender_id") -> dict[str | None, DataFrame]:
    """One extract per named lender, and under None the rest: other lenders and rows without one."""
    parts = {lender: extract.filter(F.col(column) == lender) for lender in lenders}
    return parts | {None: extract.filter(~F.coalesce(F.col(column).isin(*lenders), F.lit(False)))}


def repayments_of_day(
    t: Mapping[str, DataFrame], as_of: datetime | str, lender: str, late_after: timedelta = timedelta(hours=9)
) -> DataFrame:
    """One lender's collected payments dated on the day before ``as_of``, and earlier ones updated after 09:00 that day."""
    day = midnight(as_of) - timedelta(days=1)
    rows = t["collections"].filter(
        F.col("collection_status").isin("COLLECTION_COMPLETE", "SETTLED")
        & on_day_or_late(F.col("payment_date"), F.col("last_updated_on"), day, late_after)
    )
    rows = rows.withColumns({name: json_text(F.col("pg_response"), field) for name, field in PAYMENT_FIELDS.items()})
    loans = t["credits"].filter(F.col("lending_partner_id") == lender)
    loans = loans.select("credit_id", "account_id", F.col("lender_credit_id").alias("lan"))
    return left_dims(rows.join(loans, "credit_id", "inner"), [_borrower(t, "account_holder_name")]).select(
        "collection_id",
        "lan",
        "account_holder_name",
        "payment_date",
        "actual_amount_collected",
        "collection_type",
        "bank_ref_no",
        "payment_mode",
        "pg_tracking_id",
    )
