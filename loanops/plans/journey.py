"""Lead-to-loan journeys and their platform rollups.

origin: the leads and applications parts are SQL; the journey and the rollups follow pandas rules (groups
with a null key drop out, the sum of nothing is 0, equal extreme rows are all kept).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanops import constants as C
from loanops.functions.rules import (
    application_stage,
    business_channel,
    eligible_limit,
    fill_borrower_type,
    journey_kind,
    nan_to_null,
    platform_type,
    valid_phone,
)
from loanops.functions.timekit import period, since_instant
from loanops.operators.aggregates import median_and_sums
from loanops.operators.history import BEST, extremes, latest_row
from loanops.operators.joins import HOT_PARTS, Dimension, left_dims, per_key, spread_join
from loanops.sources.stores import by_key


@dataclass(frozen=True)
class Platforms:
    """Platform settings of one business: its own platforms, the name of its default one, and platform classes."""

    house_ids: Sequence[object] = ()
    house_name: str = "HOUSE"
    classes: Mapping[str, Sequence[str]] = field(default_factory=dict)
    minimum_limit: int = C.MIN_ELIGIBLE_LIMIT


# ---------------------------------------------------------------- inputs of the journey


def portfolio_leads(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["leads_portfolio_data"].select(
        "lead_id",
        F.col("total_portfolio_value").alias("mfc_total_portfolio_value"),
        F.col("eligible_portfolio_value").alias("mfc_eligible_portfolio_value"),
        F.col("eligible_credit_limit").alias("mfc_eligible_credit_limit"),
        "created_on",
        "last_updated_on",
    )


def _partner(t: Mapping[str, DataFrame]) -> Dimension:
    return Dimension(
        t["partner_accounts"],
        "partner_account_id",
        "account_id",
        {"partner_name": "partner_name", "partner_account_type": "partner_account_type"},
    )


def _platform(t: Mapping[str, DataFrame]) -> Dimension:
    return Dimension(t["platform_accounts"], "platform_account_id", "account_id", {"platform_name": "platform_name"})


def _channel(platforms: Platforms) -> Column:
    return business_channel(
        F.col("platform_account_id"), F.col("partner_account_id"), F.col("partner_account_type"), platforms.house_ids
    )


def lead_accounts(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["customer_leads"].select(
        "lead_id", "pan", "partner_account_id", "platform_account_id", F.col("phone_number").alias("mfc_phone_number")
    )


def named_leads(t: Mapping[str, DataFrame], platforms: Platforms, leads: DataFrame) -> DataFrame:
    return left_dims(leads, [_platform(t), _partner(t)]).withColumn("business_channel", _channel(platforms))


def customer_leads(t: Mapping[str, DataFrame], platforms: Platforms) -> DataFrame:
    """Leads with platform and partner names and the business channel."""
    return named_leads(t, platforms, lead_accounts(t))


APPLICATION_LIMITS = {
    "app_available_portfolio_value": "available_portfolio_value",
    "app_eligible_portfolio_value": "eligible_portfolio_value",
    "app_eligible_credit_limit": "eligible_credit_limit",
    "app_pledged_portfolio_value": "pledged_portfolio_value",
    "app_pledged_credit_limit": "pledged_credit_limit",
}


_APPLICATION_COLUMNS = (
    "application_id",
    "account_id",
    "current_step_id",
    "application_state",
    "application_type",
    "last_updated_on",
    "completed_on",
    "created_on",
    "platform_account_id",
    "partner_account_id",
)


def _application_rows(t: Mapping[str, DataFrame], step: str | None) -> DataFrame:
    live = F.col("application_state") != C.SUSPENDED
    if step is None:
        return t["credit_applications_entity"].filter(live).select(*_APPLICATION_COLUMNS)
    at_step = live & (F.col("current_step_id") == step)
    return by_key(
        t["credit_applications_entity_audit"],
        lambda history: latest_row(history.filter(at_step).select(*_APPLICATION_COLUMNS), ["application_id"], "last_updated_on"),
    )


def application_persons(t: Mapping[str, DataFrame], step: str | None = None) -> DataFrame:
    """``app_pan`` of ``application_facts``, without its other joins."""
    return persons_of(t, _application_rows(t, step))


def persons_of(t: Mapping[str, DataFrame], applications: DataFrame) -> DataFrame:
    borrower = Dimension(t["borrower_accounts"], "account_id", "account_id", {"app_pan": "account_holderpan"})
    return left_dims(applications.select("account_id"), [borrower]).select("app_pan")


def application_facts(t: Mapping[str, DataFrame], platforms: Platforms, step: str | None = None) -> DataFrame:
    """Applications with limits, borrower, partner, platform and channel; SUSPENDED and stateless ones left out.

    ``step``: instead of the current applications, the latest history row of each at that step.
    """
    rows = _application_rows(t, step)
    borrower = Dimension(
        t["borrower_accounts"],
        "account_id",
        "account_id",
        {"app_pan": "account_holderpan", "app_phone_number": "account_holder_phone_number"},
    )
    limits = Dimension(
        t["credit_application_meta_data"],
        "application_id",
        "application_id",
        APPLICATION_LIMITS | {"limits_created_on": "created_on"},
    )
    joined = left_dims(rows, [limits, borrower, _partner(t), _platform(t)])
    return joined.select(
        "application_id",
        "app_pan",
        "app_phone_number",
        *APPLICATION_LIMITS,
        F.col("current_step_id").alias("app_current_step_id"),
        F.col("last_updated_on").alias("app_last_updated_on"),
        "completed_on",
        "application_type",
        "application_state",
        "platform_account_id",
        "partner_account_id",
        "partner_account_type",
        F.coalesce("platform_name", F.lit(platforms.house_name)).alias("platform_name"),
        "partner_name",
        _channel(platforms).alias("business_channel"),
        F.coalesce("created_on", "limits_created_on").alias("created_on"),
    )


def sanctioned_amounts(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["credit_application_meta_data"].select(
        "application_id", F.col("pledged_credit_limit").alias("sanctioned_limit")
    )


# ---------------------------------------------------------------- the journey

# Columns of the journey, in published order.
JOURNEY_COLUMNS = (
    "pan",
    "platform_name",
    "partner_name",
    "partner_account_type",
    "phone_number",
    "mfc_total_portfolio_value",
    "mfc_eligible_portfolio_value",
    "mfc_eligible_credit_limit",
    "app_available_portfolio_value",
    "app_eligible_portfolio_value",
    "app_eligible_credit_limit",
    "app_current_step_id",
    "last_updated_date",
    "created_on",
    "completed_on",
    "business_channel",
    "application_stage",
    "application_type",
    "application_state",
    "application_id",
    "eligible_credit_limit_temp",
)
_FILLED = (
    "mfc_total_portfolio_value",
    "mfc_eligible_portfolio_value",
    "mfc_eligible_credit_limit",
    "app_available_portfolio_value",
    "app_eligible_portfolio_value",
    "app_eligible_credit_limit",
    "app_pledged_portfolio_value",
)
_LEAD = "lead__"


def person_extremes(leads: DataFrame, portfolio: DataFrame, by: str, which: str) -> DataFrame:
    """Per person with a portfolio row, the latest or first portfolio time.

    The portfolio is reduced to one row per lead before it meets the leads.
    """
    per_lead = extremes(portfolio, ["lead_id"], by, which)
    persons = leads.select("lead_id", "pan").filter(F.col("pan").isNotNull()).join(per_lead, "lead_id", "inner")
    best = F.max if which == "max" else F.min
    return per_key(persons, ["pan"], best(BEST).alias(BEST))


def leads_at(leads: DataFrame, portfolio: DataFrame, best: DataFrame, by: str, hot_parts: int = HOT_PARTS) -> DataFrame:
    """Each person's lead rows at that time, ties kept.

    Only persons with a portfolio row take part; one whose times are all missing keeps every lead row, also
    those without portfolio: all portfolio rows of such a person have no time, so a lead without one is told by the left join.
    """
    side = nan_to_null(portfolio).withColumnRenamed("lead_id", "__lead_id")
    known = best.select(F.col("pan").alias("__pan"), BEST)
    persons = leads.join(known, F.col("pan") == F.col("__pan")).drop("__pan")
    rows = spread_join(persons, side, ["lead_id"], ["__lead_id"], "left", hot="right", right_keys=portfolio.select(F.col("lead_id").alias("__lead_id")), hot_parts=hot_parts)
    found = F.col("__lead_id").isNotNull()
    return rows.filter(F.when(found, F.col(by).eqNullSafe(F.col(BEST))).otherwise(F.col(BEST).isNull())).drop("__lead_id", BEST)


def portfolio_persons(leads: DataFrame, portfolio: DataFrame) -> DataFrame:
    """``pan`` of each portfolio row; every one of these persons has rows in ``leads_at``."""
    persons = leads.select(F.col("lead_id").alias("__lead_id"), "pan").filter(F.col("pan").isNotNull())
    return portfolio.select("lead_id").join(persons, F.col("lead_id") == F.col("__lead_id")).select("pan")


def customer_journey(
    leads: DataFrame,
    portfolio: DataFrame,
    applications: DataFrame,
    sanctioned: DataFrame,
    platforms: Platforms,
    persons: DataFrame | None = None,
    hot_parts: int = HOT_PARTS,
    named: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Each person's latest lead rows against all their applications, judged, with eligible journeys kept.

    The application wins where both sides have a value. ``persons``: the persons of
    ``applications``, from a cheaper plan, to find hot ones. The sanctioned limit belongs to the
    application, so it is joined before the full join, where no key is missing. ``named`` adds names and channel to the lead
    rows that are kept, where ``leads`` come without them.
    """
    best = person_extremes(leads, portfolio, "last_updated_on", "max")
    latest = named(leads_at(leads, portfolio, best, "last_updated_on", hot_parts))
    latest = latest.withColumnsRenamed({c: _LEAD + c for c in latest.columns})
    limits = sanctioned.withColumnRenamed("application_id", "__app")
    applications = nan_to_null(applications)
    applications = applications.join(limits, F.col("application_id") == F.col("__app"), "left").drop("__app")
    both = spread_join(
        applications,
        latest,
        ["app_pan"],
        [_LEAD + "pan"],
        "full",
        left_keys=persons,
        right_keys=portfolio_persons(leads, portfolio).withColumnRenamed("pan", _LEAD + "pan"),
        hot_parts=hot_parts,
    )

    def lead(name: str) -> Column:
        return F.col(_LEAD + name)

    merged = both.select(
        F.coalesce(lead("pan"), "app_pan").alias("pan"),
        F.coalesce("platform_name", lead("platform_name")).alias("platform_name"),
        F.coalesce("partner_name", lead("partner_name")).alias("partner_name"),
        F.coalesce("partner_account_type", lead("partner_account_type")).alias("partner_account_type"),
        F.coalesce("app_phone_number", lead("mfc_phone_number")).alias("phone_number"),
        *[lead(c).alias(c) for c in _FILLED if c.startswith("mfc_")],
        *[c for c in _FILLED if c.startswith("app_")],
        "app_current_step_id",
        F.coalesce("app_last_updated_on", lead("last_updated_on")).alias("last_updated_date"),
        F.least("created_on", lead("created_on")).alias("created_on"),
        "completed_on",
        F.coalesce("business_channel", lead("business_channel")).alias("business_channel"),
        fill_borrower_type(F.col("application_type"), lead("lead_id")).alias("application_type"),
        "application_state",
        lead("lead_id").alias("lead_id"),
        "application_id",
        "sanctioned_limit",
        eligible_limit(
            F.col("app_eligible_credit_limit"), lead("mfc_eligible_credit_limit"), platforms.minimum_limit
        ).alias("eligible_credit_limit_temp"),
    )
    kept = merged.filter(
        (F.col("application_type") == C.BORROWER_TYPE) & (F.col("eligible_credit_limit_temp") >= platforms.minimum_limit)
    )
    filled = kept.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(kept.schema[c].dataType)) for c in _FILLED})
    staged = filled.withColumns(
        {
            "application_stage": application_stage(
                F.col("lead_id"),
                F.col("application_id"),
                F.col("app_available_portfolio_value"),
                F.col("app_pledged_portfolio_value"),
                F.col("application_state"),
            ),
            "app_journey": journey_kind(F.col("lead_id")),
            "phone_number": valid_phone(F.col("phone_number")),
        }
    )
    repaired = staged.withColumn(
        "completed_on",
        F.when(
            (F.col("application_stage") == "Completed") & F.col("completed_on").isNull(), F.col("last_updated_date")
        ).otherwise(F.col("completed_on")),
    )
    return repaired.select(
        *JOURNEY_COLUMNS,
        F.lit("Yes").alias("eligible"),
        platform_type(F.col("platform_name"), platforms.classes).alias("platform_type"),
        "sanctioned_limit",
    )


def journey_of(
    t: Mapping[str, DataFrame], platforms: Platforms, step: str | None = None, hot_parts: int = HOT_PARTS
) -> DataFrame:
    """The journey over a catalog: of the current applications, or of those that were at ``step``."""
    return customer_journey(
        lead_accounts(t),
        portfolio_leads(t),
        application_facts(t, platforms, step),
        sanctioned_amounts(t),
        platforms,
        application_persons(t, step),
        hot_parts,
        lambda rows: named_leads(t, platforms, rows),
    )


# ---------------------------------------------------------------- rollups


def rollup(
    frame: DataFrame,
    date_column: str,
    key: str,
    code: str,
    period_name: str,
    key_name: str | None = None,
    generic: bool = False,
) -> DataFrame:
    """Count, credit total, mean and exact median of the eligible limit per period and ``key``."""
    key_name = key_name or key
    rows = frame.filter(F.col(date_column).isNotNull() & F.col(key).isNotNull()).select(
        period(F.col(date_column), code).alias(period_name), F.col(key).alias(key_name), _LIMIT, "sanctioned_limit"
    )
    return _summary(rows, [period_name, key_name], generic)


_LIMIT = "eligible_credit_limit_temp"


def _summary(rows: DataFrame, keys: list[str], generic: bool = False) -> DataFrame:
    """``generic``: credit as a non-null count instead of a sum, and the sum of the limits as well.

    Totals and medians come from the same reduced rows.
    """
    found = median_and_sums(rows, keys, _LIMIT, ["sanctioned_limit", _LIMIT], "median_eligible_credit", coarse=1 << 14, rounds=1)
    limits, known = F.col(f"sum_{_LIMIT}"), F.col(f"count_{_LIMIT}")
    # The credit column keeps its published name although it is a sum of money.
    credit = F.col("count_sanctioned_limit") if generic else F.coalesce("sum_sanctioned_limit", F.lit(0))
    return found.select(
        *keys,
        F.col("rows").alias("count"),
        credit.alias("approved_credit_count"),
        (limits.cast("double") / F.nullif(known, F.lit(0))).alias("average_eligible_credit"),
        "median_eligible_credit",
        *([F.coalesce(limits, F.lit(0)).alias("sum_eligible_credit")] if generic else []),
    )


def completed_rows(journey: DataFrame, code: str, as_of, days: int = 15) -> DataFrame:
    """Finished journeys; by day only those completed in the last ``days`` days, to the instant."""
    done = journey.filter(F.col("app_current_step_id").isNull() & (F.col("application_state") == C.COMPLETED))
    return done.filter(since_instant(F.col("completed_on"), as_of, days)) if code == "D" else done


def completed_by_platform(journey: DataFrame, code: str, as_of) -> DataFrame:
    return rollup(completed_rows(journey, code, as_of), "completed_on", "platform_name", code, "completed_month")


def completed_by_type(journey: DataFrame, code: str, as_of) -> DataFrame:
    rows = completed_rows(journey, code, as_of)
    return rollup(rows, "completed_on", "platform_type", code, "completed_month", "platform_name")


def registered_by_platform(journey: DataFrame, code: str) -> DataFrame:
    return rollup(journey, "created_on", "platform_name", code, "created_month")


def registered_by_type(journey: DataFrame, code: str) -> DataFrame:
    return rollup(journey, "created_on", "platform_type", code, "created_month", "platform_name")


def completed_by(journey: DataFrame, date_column: str, key: str, code: str) -> DataFrame:
    """Generic form: any date and key, only finished journeys, credit as a non-null count, plus the sum."""
    done = journey.filter(F.col("app_current_step_id").isNull() & (F.col("application_state") == C.COMPLETED))
    name = "platform_name" if key == "platform_type" else key
    return rollup(done, date_column, key, code, "completed_period", name, generic=True)


def platform_and_type(rows: DataFrame, date_column: str, code: str, period_name: str) -> DataFrame:
    """Platform rows and platform-type rows of one rollup, from a single pass over the journey.

    Each row is counted under both of its names; ``section`` 0 is platforms, 1 is types, and is dropped
    at the end as the published table has no such column.
    """
    names = F.array(
        F.struct(F.lit(0).alias("section"), F.col("platform_name").alias("name")),
        F.struct(F.lit(1).alias("section"), F.col("platform_type").alias("name")),
    )
    both = (
        rows.filter(F.col(date_column).isNotNull())
        .select(period(F.col(date_column), code).alias(period_name), _LIMIT, "sanctioned_limit", F.explode(names).alias("n"))
        .select(period_name, F.col("n.section").alias("section"), F.col("n.name").alias("platform_name"), _LIMIT, "sanctioned_limit")
        .filter(F.col("platform_name").isNotNull())
    )
    return _summary(both, [period_name, "section", "platform_name"]).drop("section")


# Titles of the published tables.
PUBLISHED = ("grouped completed on", "grouped completed on days", "grouped created on", "grouped fetched on", "grouped pledged on")


def step_rollup(journey: DataFrame) -> DataFrame:
    """The published table on the journey of one step."""
    return platform_and_type(journey, "created_on", "M", "created_month")


def published_rollups(t: Mapping[str, DataFrame], platforms: Platforms, as_of) -> dict[str, DataFrame]:
    """All five published tables by title.

    The three tables on the current applications come from one pass over the journey: each of its rows is
    counted under every (table, section, name) that it belongs to.
    """
    current = current_rollups(journey_of(t, platforms), as_of)
    steps = {"grouped fetched on": C.FETCH_STEP, "grouped pledged on": C.PLEDGE_STEP}
    stepped = {title: step_rollup(journey_of(t, platforms, step)) for title, step in steps.items()}
    return {title: (current | stepped)[title] for title in PUBLISHED}


def current_rollups(journey: DataFrame, as_of) -> dict[str, DataFrame]:
    """The published tables on the current applications, filters on one summary of (table, section, period, name)."""
    done = F.col("app_current_step_id").isNull() & (F.col("application_state") == C.COMPLETED)
    recent = done & since_instant(F.col("completed_on"), as_of, 15)
    kinds = {
        "grouped completed on": (done, "completed_on", "M", "completed_month"),
        "grouped completed on days": (recent, "completed_on", "D", "completed_month"),
        "grouped created on": (F.lit(True), "created_on", "M", "created_month"),
    }
    uses = [
        F.when(test & F.col(date).isNotNull(), F.struct(F.lit(title).alias("title"), F.lit(section).alias("section"), period(F.col(date), code).alias("period"), F.col(name).alias("name")))
        for title, (test, date, code, _) in kinds.items()
        for section, name in enumerate(("platform_name", "platform_type"))
    ]
    rows = journey.select(_LIMIT, "sanctioned_limit", F.explode(F.filter(F.array(*uses), lambda u: u["name"].isNotNull())).alias("u"))
    summary = _summary(rows.select("u.*", _LIMIT, "sanctioned_limit"), ["title", "section", "period", "name"])
    return {
        title: summary.filter(F.col("title") == title)
        .drop("title", "section")
        .withColumnsRenamed({"period": period_name, "name": "platform_name"})
        for title, (_, _, _, period_name) in kinds.items()
    }
