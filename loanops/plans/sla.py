"""Service-level cubes and the lender x channel scoreboard.

A *cube* counts the requests of the last days by request date, verdict, age and lateness. A *scoreboard
arm* counts, per lender, what was finished today and what still waits. Both judge one item table with four
columns (start, end, deadline, status), so every report is its item table plus a specification.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.functions.timekit import elapsed, instant, level, midnight, same_day, since_day
from loanops.operators.history import first_state_times
from loanops.operators.joins import Dimension, left_dims, semi_ids

LOOKBACK_DAYS = 40
HOURS = (timedelta(hours=2), timedelta(hours=6))
DAYS = (timedelta(days=1), timedelta(days=3))
# 3600 minutes is 60 hours; the reports use it as it stands.
MINUTES = (timedelta(minutes=120), timedelta(minutes=3600))
ENHANCEMENT_ALLOWANCE = timedelta(hours=2)

LABELS = (
    "delay_hour",
    "expected_transfer_bucket",
    "verdict",
    "time_delay_till_today",
    "delay_in_settlement",
    "delay_in_not_settlement",
)


@dataclass(frozen=True)
class LenderTerms:
    """Time allowed per lender, by kind of request."""

    lien_removal: Mapping[str, timedelta] = field(default_factory=dict)
    foreclosure: Mapping[str, timedelta] = field(default_factory=dict)
    opening: Mapping[str, timedelta] = field(default_factory=dict)
    # Slack after the lodgement itself, and from opening (else creation) while nothing is lodged.
    lodged: Mapping[str, timedelta] = field(default_factory=dict)
    unlodged: Mapping[str, timedelta] = field(default_factory=dict)


def allowance(lender: Column, terms: Mapping[str, timedelta]) -> Column:
    """The lender's allowed time as an interval; null for a lender without terms."""
    chosen = F.when(F.lit(False), F.lit(timedelta(0)))
    for name, time in terms.items():
        chosen = chosen.when(lender == name, F.lit(time))
    return chosen


# ---------------------------------------------------------------- cubes


@dataclass(frozen=True)
class RequestSpec:
    """How a request table is judged. ``waiting`` empty: every state that is not named elsewhere."""

    start: str = "created_on"
    end: str = "last_updated_on"
    deadline: str = "deadline"
    status: str = "status"
    done: Sequence[str] = ("SUCCESS",)
    failed: Sequence[str] = ("FAILED",)
    waiting: Sequence[str] = ()
    own_label: Sequence[str] = ()
    bounds: tuple[timedelta, timedelta] = HOURS
    date_name: str = "requested_date"
    verdict_name: str = "success_under_time"


def request_labels(spec: RequestSpec, as_of) -> dict[str, Column]:
    """Verdict and buckets of one request. An unknown deadline satisfies no test, so it ends as in time."""
    start, end, deadline = F.col(spec.start), F.col(spec.end), F.col(spec.deadline)
    status, now = F.col(spec.status), instant(as_of)
    allowed = elapsed(deadline, start)
    is_done = status.isin(*spec.done)
    if spec.waiting:
        is_waiting = not_done = status.isin(*spec.waiting)
    else:
        is_waiting = ~status.isin(*spec.done, *spec.failed, *spec.own_label)
        not_done = ~is_done
    finished_late = is_done & (elapsed(end, start) > allowed)
    verdict = (
        F.when(finished_late, C.LATE)
        .when(is_waiting & (elapsed(now, start) > allowed), C.WAITING_BREACHED)
        .when(is_waiting & (elapsed(now, start) <= allowed), C.WAITING_IN_TIME)
        .when(status.isin(*spec.failed), C.FAILED)
    )
    if spec.own_label:
        verdict = verdict.when(status.isin(*spec.own_label), status)
    return {
        "delay_hour": level(elapsed(end, start), *spec.bounds),
        "expected_transfer_bucket": level(allowed, *spec.bounds),
        "verdict": verdict.otherwise(C.IN_TIME),
        "time_delay_till_today": F.when(is_done, None).otherwise(level(elapsed(now, end), *spec.bounds)),
        "delay_in_settlement": F.when(finished_late, level(elapsed(end, deadline), *spec.bounds)),
        "delay_in_not_settlement": F.when(
            not_done & (elapsed(now, start) > allowed), level(elapsed(now, deadline), *spec.bounds)
        ),
    }


@dataclass(frozen=True)
class CreditSpec:
    """How a step in the life of a credit is judged, from the time the step was reached.

    ``settled``: states that count as in time even without a recorded time. ``open``: states that have an
    age. ``unlate``: states that never show a lateness. ``pending``: states that may still be in time (empty:
    any). ``waiting_since``: the column from which a waiting credit's time runs.
    """

    start: str
    end: str
    deadline: str
    settled: Sequence[str]
    open: Sequence[str]
    unlate: Sequence[str]
    pending: Sequence[str] = ()
    waiting_since: str = "created_on"
    status: str = "credit_status"
    bounds: tuple[timedelta, timedelta] = MINUTES
    date_name: str = "credit_created_on_date"
    verdict_name: str = "settled_under_time"


OPENING = CreditSpec(
    start="created_on",
    end="opened_on",
    deadline="opening_deadline",
    settled=(C.ACTIVE,),
    open=(C.PENDING_DISBURSAL_APPROVAL,),
    unlate=(C.PENDING_DISBURSAL_APPROVAL,),
)
# The deadline of a lodged credit is its lodgement time plus slack, so a lodged credit is always in time.
LODGEMENT = CreditSpec(
    start="opened_on",
    end="lodged_on",
    deadline="lodgement_deadline",
    settled=(C.ACTIVE, C.PENDING_CLOSURE, C.CLOSED),
    open=(C.PENDING_DISBURSAL_APPROVAL, C.PENDING_LODGEMENT),
    unlate=(C.PENDING_DISBURSAL_APPROVAL, C.PENDING_LODGEMENT, C.APPROVED_NOT_DISBURSED),
    pending=(C.PENDING_DISBURSAL_APPROVAL, C.PENDING_LODGEMENT),
    waiting_since="opened_on",
    date_name="credit_created_on",
)


def credit_labels(spec: CreditSpec, as_of) -> dict[str, Column]:
    start, end, deadline = F.col(spec.start), F.col(spec.end), F.col(spec.deadline)
    status, now = F.col(spec.status), instant(as_of)
    still_open = end.isNull() & status.isin(*spec.pending) if spec.pending else end.isNull()
    reached_late = ~status.isin(*spec.unlate) & (elapsed(end, start) > elapsed(deadline, start))
    overdue = (status == C.PENDING_DISBURSAL_APPROVAL) & (
        elapsed(now, F.col(spec.waiting_since)) > elapsed(deadline, F.col("created_on"))
    )
    return {
        "delay_hour": level(elapsed(end, start), *spec.bounds),
        "expected_transfer_bucket": level(elapsed(deadline, start), *spec.bounds),
        "verdict": F.when(deadline >= end, C.IN_TIME)
        .when(status.isin(*spec.settled) & end.isNull(), C.IN_TIME)
        .when(end > deadline, C.LATE)
        .when(still_open & (deadline > now), C.WAITING_IN_TIME)
        .when(end.isNull() & (now > deadline), C.WAITING_BREACHED)
        .otherwise(C.UNDECIDED),
        "time_delay_till_today": F.when(~status.isin(*spec.open), None).otherwise(
            level(elapsed(now, end), *spec.bounds)
        ),
        "delay_in_settlement": F.when(reached_late, level(elapsed(end, deadline), *spec.bounds)),
        "delay_in_not_settlement": F.when(overdue, level(elapsed(now, deadline), *spec.bounds)),
    }


def judge(items: DataFrame, spec: RequestSpec | CreditSpec, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The items of the last days with all six labels, one row per item."""
    request = isinstance(spec, RequestSpec)
    labels = request_labels(spec, as_of) if request else credit_labels(spec, as_of)
    created = spec.start if request else "created_on"
    return items.filter(since_day(F.col(created), as_of, lookback_days)).withColumns(labels)


def sla_cube(items: DataFrame, spec: RequestSpec | CreditSpec, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Count by request date, verdict, age and lateness: one scan, one pre-aggregated shuffle."""
    created = spec.start if isinstance(spec, RequestSpec) else "created_on"
    return (
        judge(items, spec, as_of, lookback_days)
        .groupBy(
            F.to_date(created).alias(spec.date_name),
            F.col("verdict").alias(spec.verdict_name),
            "time_delay_till_today",
            "delay_in_settlement",
        )
        .agg(F.count("*").alias("count"))
    )


WITHDRAWAL = RequestSpec(
    start="requested_on",
    deadline="expected_transfer_by",
    status="disbursal_status",
    done=("SETTLED",),
    failed=("REJECTED", "FAILED"),
    verdict_name="settled_under_time",
)
REPAYMENT = RequestSpec(
    deadline="settlement_expected_by",
    status="collection_status",
    done=("SETTLED",),
    failed=("CANCELLED", "FAILED"),
    own_label=("REQUESTED",),
)
LIEN_REMOVAL = FORECLOSURE = RequestSpec(bounds=DAYS)
ENHANCEMENT = RequestSpec(
    waiting=("REQUESTED",), date_name="created_on_date", verdict_name="settled_under_time"
)


def withdrawals(t: Mapping[str, DataFrame], as_of, **options) -> DataFrame:
    return sla_cube(t["disbursals"], WITHDRAWAL, as_of, **options)


def repayments(t: Mapping[str, DataFrame], as_of, **options) -> DataFrame:
    return sla_cube(t["collections"], REPAYMENT, as_of, **options)


def lien_removals(t: Mapping[str, DataFrame], terms: LenderTerms, as_of, **options) -> DataFrame:
    return sla_cube(revocation_items(t, terms), LIEN_REMOVAL, as_of, **options)


def foreclosures(
    t: Mapping[str, DataFrame], terms: LenderTerms, as_of, lookback_days: int = LOOKBACK_DAYS, request_id_unique: bool = False
) -> DataFrame:
    """Lenders without terms are left out, and equal rows count once (the lenders are a distinct union).

    ``request_id_unique`` skips that shuffle of whole rows where the table is known to have a key.
    """
    requests = t["foreclosure_requests"].filter(F.col("lender_id").isin(*terms.foreclosure))
    requests = requests.filter(since_day(F.col("created_on"), as_of, lookback_days))
    if not request_id_unique:
        requests = requests.distinct()
    items = requests.withColumn("deadline", F.col("created_on") + allowance(F.col("lender_id"), terms.foreclosure))
    return sla_cube(items, FORECLOSURE, as_of, lookback_days)


def account_openings(t: Mapping[str, DataFrame], terms: LenderTerms, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    return sla_cube(recent_timeline(t, terms, as_of, lookback_days), OPENING, as_of, lookback_days)


def lodgements(t: Mapping[str, DataFrame], terms: LenderTerms, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    return sla_cube(recent_timeline(t, terms, as_of, lookback_days), LODGEMENT, as_of, lookback_days)


def enhancements(t: Mapping[str, DataFrame], as_of, **options) -> DataFrame:
    return sla_cube(enhancement_items(t), ENHANCEMENT, as_of, **options)


# ---------------------------------------------------------------- item tables


def enhancement_items(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["enhance_limit_request"].withColumn("deadline", F.col("created_on") + F.lit(ENHANCEMENT_ALLOWANCE))


def revocation_items(t: Mapping[str, DataFrame], terms: LenderTerms) -> DataFrame:
    lender = Dimension(t["credit_main"], "credit_id", "credit_id", {"lender_id": "lending_partner_id"})
    return left_dims(t["revocation_requests"], [lender]).withColumn(
        "deadline", F.col("created_on") + allowance(F.col("lender_id"), terms.lien_removal)
    )


def recent_timeline(t: Mapping[str, DataFrame], terms: LenderTerms, as_of, lookback_days: int) -> DataFrame:
    """The timeline of the credits of the last days only: the history of all others is dropped before it is shuffled and summed."""
    recent = t["credit_main"].filter(since_day(F.col("created_on"), as_of, lookback_days))
    history = semi_ids(t["credit_audit"], recent, "credit_id", "credit_id")
    return credit_timeline({"credit_main": recent, "credit_audit": history}, terms)


def credit_timeline(t: Mapping[str, DataFrame], terms: LenderTerms) -> DataFrame:
    """Credits with the times they were opened and lodged and both deadlines; the history is read once."""
    times = first_state_times(
        t["credit_audit"],
        "credit_id",
        "credit_status",
        "last_updated_on",
        {"opened_on": C.OPENED_STATES, "lodged_on": C.LODGED_STATES},
    )
    reached = Dimension(times, "credit_id", "credit_id", {"opened_on": "opened_on", "lodged_on": "lodged_on"})
    credits = t["credit_main"].select("credit_id", "credit_status", "lending_partner_id", "created_on")
    lender = F.col("lending_partner_id")
    return left_dims(credits, [reached]).withColumns(
        {
            "opening_deadline": F.col("created_on") + allowance(lender, terms.opening),
            "lodgement_deadline": F.coalesce(
                F.col("lodged_on") + allowance(lender, terms.lodged),
                F.when(
                    F.col("lodged_on").isNull(),
                    F.coalesce("opened_on", "created_on") + allowance(lender, terms.unlodged),
                ),
            ),
        }
    )


# ---------------------------------------------------------------- scoreboard

BOARD_COUNTS = (
    "success_within_sla",
    "success_l1",
    "success_l2",
    "success_l3",
    "non_success_within_sla",
    "non_success_l1",
    "non_success_l2",
    "non_success_l3",
    "non_success_l4",
)
BOARD_COLUMNS = ("update_date", "lender_id", "channel_type", *BOARD_COUNTS)
# Display names of the published scoreboard, in its column order.
BOARD_DISPLAY = {
    "channel_type": "Request Type",
    "success_within_sla": "Resolved within SLA",
    "success_l1": "L1 Resolved SLA Breached",
    "success_l2": "L2 Resolved SLA Breached",
    "success_l3": "L3 Resolved SLA Breached",
    "non_success_within_sla": "Unresolved within SLA",
    "non_success_l1": "1D Unresolved SLA Breached",
    "non_success_l2": "3D Unresolved SLA Breached",
    "non_success_l3": "5D Unresolved SLA Breached",
    "non_success_l4": "5D+ Unresolved SLA Breached",
    "lender_id": "Lender",
}


@dataclass(frozen=True)
class BoardSpec:
    """One channel of the scoreboard.

    ``late``: lateness bounds of finished items (L1 up to, L2 up to, L3 from); L2 starts behind L1.
    ``backlog`` empty: every state that is not done. ``aged_since``: where a waiting item's age starts.
    """

    channel: str
    start: str = "created_on"
    end: str = "last_updated_on"
    deadline: str = "deadline"
    status: str = "status"
    done: Sequence[str] = ("SUCCESS",)
    backlog: Sequence[str] = ()
    late: tuple[timedelta, timedelta, timedelta] = (HOURS[0], HOURS[1], HOURS[1])
    ages: tuple[timedelta, timedelta, timedelta] = (timedelta(days=1), timedelta(days=3), timedelta(days=5))
    aged_since: str = "last_updated_on"
    unknown_lender_waits: bool = True


_LATE_BY_DAYS = (DAYS[0], DAYS[1], DAYS[1])
ENHANCEMENT_BOARD = BoardSpec("ENHANCEMENTS")
# The second bound of repayments is 36 hours while the third bucket starts at 6: the two overlap.
REPAYMENT_BOARD = BoardSpec(
    "REPAYMENTS",
    status="collection_status",
    done=("SETTLED",),
    late=(timedelta(hours=2), timedelta(hours=36), timedelta(hours=6)),
)
WITHDRAWAL_BOARD = BoardSpec("WITHDRAWALS", start="requested_on", status="disbursal_status", done=("SETTLED",))
FORECLOSURE_BOARD = BoardSpec("FORECLOSURE", late=_LATE_BY_DAYS)
LIEN_REMOVAL_BOARD = BoardSpec("LIEN REMOVAL", late=_LATE_BY_DAYS, unknown_lender_waits=False)
OPENING_BOARD = BoardSpec(
    "ACCOUNT OPENING",
    end="opened_on",
    deadline="opening_deadline",
    status="credit_status",
    done=C.OPENED_STATES,
    backlog=(C.PENDING_DISBURSAL_APPROVAL,),
    late=_LATE_BY_DAYS,
    aged_since="opening_deadline",
)
LODGEMENT_BOARD = BoardSpec(
    "LODGEMENT",
    end="lodged_on",
    deadline="lodgement_deadline",
    status="credit_status",
    done=(C.ACTIVE, C.PENDING_CLOSURE, C.CLOSED),
    backlog=(C.PENDING_LODGEMENT,),
    late=_LATE_BY_DAYS,
    aged_since="lodgement_deadline",
)


def _tallies(spec: BoardSpec, as_of) -> dict[str, Column]:
    """The nine counted conditions and whether the row belongs to today at all."""
    start, end, deadline = F.col(spec.start), F.col(spec.end), F.col(spec.deadline)
    status, now = F.col(spec.status), instant(as_of)
    today = same_day(end, as_of)
    done = today & status.isin(*spec.done)
    late = done & (elapsed(end, start) > elapsed(deadline, start))
    overrun, (first, second, third) = elapsed(end, deadline), (F.lit(b) for b in spec.late)
    waits = status.isin(*spec.backlog) if spec.backlog else ~status.isin(*spec.done)
    overdue = waits & (now > deadline)
    age, (one, two, three) = elapsed(now, F.col(spec.aged_since)), (F.lit(b) for b in spec.ages)
    tests = (
        done & (end <= deadline),
        late & (overrun <= first),
        late & (overrun > first) & (overrun <= second),
        late & (overrun > third),
        waits & (now <= deadline),
        overdue & (age <= one),
        overdue & (age > one) & (age <= two),
        overdue & (age > two) & (age <= three),
        overdue & (age > three),
    )
    return dict(zip(BOARD_COUNTS, tests)) | {"any_today": today}


def scoreboard_arms(items: DataFrame, lender: str, specs: Sequence[BoardSpec], as_of) -> DataFrame:
    """Scoreboard rows of one or more channels that share an item table.

    The finished-today half and the backlog half are one pass over the items: the backlog has every lender
    of the table, so joining the halves on (day, lender) gives one row per lender, except that an unknown
    lender never joins and keeps one row per half. That last step runs on one row per lender.
    """
    totals = items.groupBy(F.col(lender).alias("lender_id")).agg(
        *[
            F.count_if(test).alias(f"c{i}_{name}")
            for i, spec in enumerate(specs)
            for name, test in _tallies(spec, as_of).items()
        ]
    )
    known, rows = F.col("lender_id").isNotNull(), []
    for i, spec in enumerate(specs):
        counts = {name: F.col(f"c{i}_{name}") for name in BOARD_COUNTS}
        zeros = {name: F.lit(0).cast("long") for name in BOARD_COUNTS}
        done = {n: c for n, c in counts.items() if n.startswith("success")}
        waiting = {n: c for n, c in counts.items() if n.startswith("non_success")}
        today = F.col(f"c{i}_any_today") > 0
        for keep, cells in (
            (known, counts),
            (~known & today, zeros | done),
            (~known & F.lit(spec.unknown_lender_waits), zeros | waiting),
        ):
            rows.append(
                F.struct(
                    keep.alias("keep"),
                    F.lit(spec.channel).alias("channel_type"),
                    *[cells[name].alias(name) for name in BOARD_COUNTS],
                )
            )
    return (
        totals.select("lender_id", F.explode(F.array(*rows)).alias("row"))
        .filter("row.keep")
        .select(
            instant(midnight(as_of)).alias("update_date"),
            "lender_id",
            "row.channel_type",
            *[f"row.{name}" for name in BOARD_COUNTS],
        )
    )


def _with_lender(requests: DataFrame, credits: DataFrame) -> DataFrame:
    return left_dims(requests, [Dimension(credits, "credit_id", "credit_id", {"lender_id": "lending_partner_id"})])


def enhancement_arm(t: Mapping[str, DataFrame], as_of) -> DataFrame:
    return scoreboard_arms(_with_lender(enhancement_items(t), t["credits"]), "lender_id", [ENHANCEMENT_BOARD], as_of)


def repayment_arm(t: Mapping[str, DataFrame], as_of) -> DataFrame:
    items = t["collections"].filter(~F.col("collection_status").isin("FAILED", "REQUESTED", "CANCELLED"))
    items = items.withColumn("deadline", F.coalesce("settlement_expected_by", "last_updated_on"))
    return scoreboard_arms(_with_lender(items, t["credits"]), "lender_id", [REPAYMENT_BOARD], as_of)


def withdrawal_arm(t: Mapping[str, DataFrame], as_of) -> DataFrame:
    items = t["disbursals"].filter(~F.col("disbursal_status").isin("FAILED", "REJECTED"))
    items = items.withColumn("deadline", F.coalesce("expected_transfer_by", "last_updated_on"))
    return scoreboard_arms(_with_lender(items, t["credits"]), "lender_id", [WITHDRAWAL_BOARD], as_of)


def foreclosure_arm(t: Mapping[str, DataFrame], terms: LenderTerms, as_of) -> DataFrame:
    items = t["foreclosure_requests"].filter(F.col("lender_id").isNotNull())
    items = items.withColumn("deadline", F.col("created_on") + allowance(F.col("lender_id"), terms.foreclosure))
    return scoreboard_arms(items, "lender_id", [FORECLOSURE_BOARD], as_of)


def lien_removal_arm(t: Mapping[str, DataFrame], terms: LenderTerms, as_of) -> DataFrame:
    """Unlike the cube, a lender without terms is due at its last update."""
    known = F.coalesce(F.col("lender_id").isin(*terms.lien_removal), F.lit(False))
    items = revocation_items(t, terms).withColumn(
        "deadline", F.when(known, F.col("deadline")).otherwise(F.col("last_updated_on"))
    )
    return scoreboard_arms(items, "lender_id", [LIEN_REMOVAL_BOARD], as_of)


def credit_arms(
    t: Mapping[str, DataFrame], terms: LenderTerms, as_of, specs: Sequence[BoardSpec] = (OPENING_BOARD, LODGEMENT_BOARD)
) -> DataFrame:
    """Account opening and lodgement, from one credit timeline."""
    return scoreboard_arms(credit_timeline(t, terms), "lending_partner_id", specs, as_of)


def scoreboard(t: Mapping[str, DataFrame], terms: LenderTerms, as_of, display: bool = False) -> DataFrame:
    """All seven channels; ``display`` drops the day, moves the lender last and uses the published names."""
    arms = [
        enhancement_arm(t, as_of),
        repayment_arm(t, as_of),
        withdrawal_arm(t, as_of),
        foreclosure_arm(t, terms, as_of),
        lien_removal_arm(t, terms, as_of),
        credit_arms(t, terms, as_of),
    ]
    board = reduce(DataFrame.unionByName, arms)
    if not display:
        return board.select(*BOARD_COLUMNS)
    return board.select(*BOARD_DISPLAY).withColumnsRenamed(BOARD_DISPLAY)


def published_reports(t: Mapping[str, DataFrame], terms: LenderTerms, as_of) -> dict[str, DataFrame]:
    """The seven cubes and the scoreboard of one run by their published titles."""
    # Titles of the published tables.
    return {
        "Data Withdrawal": withdrawals(t, as_of),
        "Data Repayments": repayments(t, as_of),
        "Data Lien Removal": lien_removals(t, terms, as_of),
        "Data Foreclosure": foreclosures(t, terms, as_of),
        "Data Account Opening": account_openings(t, terms, as_of),
        "Data Lodgement": lodgements(t, terms, as_of),
        "Data Enhancement": enhancements(t, as_of),
        "Aggregate sheet Overall Data": scoreboard(t, terms, as_of, display=True),
    }
