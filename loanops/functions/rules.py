"""Row rules and cell helpers, all of them column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanops.constants import BORROWER_TYPE, COMPLETED, IN_PROGRESS, MIN_ELIGIBLE_LIMIT


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null where ``whole`` is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def last_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered assignment: of all rules that hold, the last one wins."""
    chosen = None
    for condition, value in reversed(rules):
        value = value if isinstance(value, Column) else F.lit(value)
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(default if isinstance(default, Column) else F.lit(default))


def trimmed(text: Column) -> Column:
    """Strip every kind of white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def bracketed(text: Column) -> Column:
    """``[text]`` for non-blank text, so that a spreadsheet keeps it as text."""
    return F.when(F.length(trimmed(text)) > 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)


def json_text(document: Column, field: str) -> Column:
    return F.get_json_object(document, f"$.{field}")


def value_by_id(items: Column, wanted: int) -> Column:
    """``value`` of the first struct in ``items`` whose ``id`` is ``wanted``; null if there is none."""
    return F.get(F.filter(items, lambda item: item["id"] == F.lit(wanted)), F.lit(0))["value"]


def flatten(frame: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as flat columns named by their path; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> Iterable[tuple[str, ...]]:
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return frame.select(
        *[F.col(".".join(f"`{part.replace('`', '``')}`" for part in path)).alias(sep.join(path)) for path in leaves(frame.schema, ())]
    )


def nan_to_null(frame: DataFrame) -> DataFrame:
    """NaN counts as missing; without this it would pass every ``>=`` test."""
    floats = [f.name for f in frame.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return frame.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in floats}) if floats else frame


def blank_nulls(frame: DataFrame) -> DataFrame:
    """Text form for delivery: every column a string, null as the empty string."""
    return frame.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in frame.columns])


def eligible_limit(application: Column, lead: Column, minimum: int = MIN_ELIGIBLE_LIMIT) -> Column:
    """The application's limit if large enough, else the lead's, else 0."""
    return F.when(application >= minimum, application).when(lead >= minimum, lead).otherwise(F.lit(0))


def application_stage(lead_id: Column, application_id: Column, available: Column, pledged: Column, state: Column) -> Column:
    """How far a journey came; amounts must have nulls filled with 0."""
    return last_match(
        [
            (lead_id.isNotNull() & application_id.isNull(), "MFC Fetch"),
            (application_id.isNotNull(), "Pre Fetch"),
            ((available > 0) & (pledged == 0), "Post Fetch"),
            ((pledged > 0) & (state == IN_PROGRESS), "Post Pledge"),
            (state == COMPLETED, "Completed"),
        ]
    )


def journey_kind(lead_id: Column) -> Column:
    return F.when(lead_id.isNotNull(), "mfc_journey").otherwise("app_only_journey")


def fill_borrower_type(application_type: Column, lead_id: Column) -> Column:
    """A lead without application counts as a borrower journey."""
    return F.when(application_type.isNull() & lead_id.isNotNull(), BORROWER_TYPE).otherwise(application_type)


def business_channel(platform_id: Column, partner_id: Column, partner_type: Column, house_platforms: Sequence[str]) -> Column:
    """B2B on a foreign platform, B2B2C by an individual partner on a house platform, else B2C."""
    house = platform_id.isNull() | platform_id.isin(*house_platforms) if house_platforms else platform_id.isNull()
    return (
        F.when(~house, "B2B")
        .when(house & partner_id.isNotNull() & (partner_type == "INDIVIDUAL"), "B2B2C")
        .otherwise("B2C")
    )


def platform_type(name: Column, classes: Mapping[str, Sequence[str]], other: str = "Other") -> Column:
    """Class of a platform by name; ``classes`` maps a class to its platform names."""
    chosen = None
    for kind, names in classes.items():
        chosen = F.when(name.isin(*names), kind) if chosen is None else chosen.when(name.isin(*names), kind)
    return F.lit(other) if chosen is None else chosen.otherwise(other)


def valid_phone(raw: Column) -> Column:
    """Our own rule: digits only, leading 0 / 91 dropped, ten digits that start with 6 to 9; else null."""
    digits = F.regexp_replace(raw.cast("string"), r"\D", "")
    bare = F.regexp_replace(digits, r"^0+", "")
    bare = F.when(F.length(bare) > 10, F.regexp_replace(bare, r"^91", "")).otherwise(bare)
    return F.when(bare.rlike(r"^[6-9][0-9]{9}$"), bare)
