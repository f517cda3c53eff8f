"""Values that the source systems write and that reports must spell exactly."""

from __future__ import annotations

from datetime import timedelta

# Application types, states and steps.
BORROWER_TYPE = "CREDIT_AGAINST_SECURITIES_BORROWER"
RENEWAL_TYPE = "CREDIT_RENEWAL_AGAINST_SECURITIES"
COMPLETED = "COMPLETED"
SUSPENDED = "SUSPENDED"
IN_PROGRESS = "IN_PROGRESS"
FETCH_STEP = "MF_FETCH_PORTFOLIO"
PLEDGE_STEP = "ASSET_PLEDGE"

# Credit states.
PENDING_DISBURSAL_APPROVAL = "PENDING_DISBURSAL_APPROVAL"
PENDING_LODGEMENT = "PENDING_LODGEMENT"
APPROVED_NOT_DISBURSED = "APPROVED_NOT_DISBURSED"
ACTIVE = "ACTIVE"
PENDING_CLOSURE = "PENDING_CLOSURE"
CLOSED = "CLOSED"
OPENED_STATES = (PENDING_LODGEMENT, APPROVED_NOT_DISBURSED, ACTIVE, PENDING_CLOSURE)
LODGED_STATES = (APPROVED_NOT_DISBURSED, ACTIVE, PENDING_CLOSURE)

# Verdicts of the service-level cubes.
IN_TIME = "YES"
LATE = "NO"
WAITING_BREACHED = "NOT SETTLED SLA BREACHED"
WAITING_IN_TIME = "NOT SETTLED NO SLA BREACHED"
FAILED = "FAILED"
UNDECIDED = "DONT KNOW"

# Money thresholds and day limits.
MIN_ELIGIBLE_LIMIT = 25000
GOLD_SUM = 10000000
GOLD_CUSTOMERS = 5
GOLD_MAX = 2000000
GOLD_CUSTOMERS_PER_MONTH = 1.5
RECENT_DAYS = 45

# Business time is UTC plus this fixed offset.
BUSINESS_OFFSET = timedelta(hours=5, minutes=30)
