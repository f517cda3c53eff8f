"""Time expressions: all of them on zoneless UTC timestamps and against an explicit ``as_of``.

Bounds are computed in Python from ``as_of`` and compared with the bare column, so that date filters
reach the parquet scan. Elapsed time stays a day-time interval: comparisons are exact to the microsecond.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanops.constants import BUSINESS_OFFSET

_UNIT_MICROS = {"seconds": 1_000_000, "minutes": 60_000_000, "hours": 3_600_000_000, "days": 86_400_000_000}


def as_instant(value: datetime | date | str) -> datetime:
    """``as_of`` as a zoneless datetime."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime.combine(value, time())
    if value.tzinfo is not None:
        raise ValueError("as_of must be zoneless UTC")
    return value


def midnight(value: datetime | date | str) -> datetime:
    return datetime.combine(as_instant(value).date(), time())


def month_start(value: datetime | date | str, back: int = 0) -> datetime:
    """First instant of the month ``back`` months before ``value``."""
    day = as_instant(value)
    months = day.year * 12 + day.month - 1 - back
    return datetime(months // 12, months % 12 + 1, 1)


def instant(value: datetime | date | str) -> Column:
    """Zoneless timestamp literal."""
    return F.lit(as_instant(value).isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: datetime | date | str) -> Column:
    return F.lit(as_instant(value).date())


def elapsed(later: Column, earlier: Column) -> Column:
    return later - earlier


def elapsed_in(later: Column, earlier: Column, unit: str) -> Column:
    """Elapsed time as a fractional number of ``unit``."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(float(_UNIT_MICROS[unit]))


def level(gap: Column, first: timedelta, second: timedelta) -> Column:
    """L1/L2/L3 by two inclusive bounds; an unknown gap is L3."""
    return F.when(gap <= F.lit(first), "L1").when(gap <= F.lit(second), "L2").otherwise("L3")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, truncated toward zero."""
    return F.extract(F.lit("DAY"), later - earlier)


def trunc(unit: str, moment: Column) -> Column:
    """Start of day / week (Monday) / month as a zoneless timestamp."""
    return F.date_trunc(unit, moment).cast("timestamp_ntz")


def month_gap(later: Column, earlier: Column) -> Column:
    """Calendar months between two moments, days ignored."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def to_business_time(moment: Column, offset: timedelta = BUSINESS_OFFSET) -> Column:
    return moment + F.lit(offset)


def to_zone(moment: Column, zone: str, source: str = "UTC") -> Column:
    """A zoneless moment of ``source`` as the clock of ``zone`` shows it; names of zones follow their rules, changes of the clock included."""
    return F.convert_timezone(F.lit(source), F.lit(zone), moment)


# Period codes and their text form.
_PERIOD_FORMATS = {"M": "yyyy-MM", "D": "yyyy-MM-dd"}


def period(moment: Column, code: str) -> Column:
    return F.date_format(moment, _PERIOD_FORMATS[code])


def since_day(moment: Column, as_of, days: int) -> Column:
    """Date of ``moment`` is at most ``days`` days before the date of ``as_of``."""
    return moment >= instant(midnight(as_of) - timedelta(days=days))


def since_instant(moment: Column, as_of, days: int) -> Column:
    return moment >= instant(as_instant(as_of) - timedelta(days=days))


def same_day(moment: Column, as_of) -> Column:
    start = midnight(as_of)
    return (moment >= instant(start)) & (moment < instant(start + timedelta(days=1)))


def business_day_window(
    moment: Column,
    as_of,
    cutoff: timedelta = timedelta(hours=12, minutes=30),
    offset: timedelta = BUSINESS_OFFSET,
) -> Column:
    """Business time lies strictly between yesterday's and today's cutoff; the bounds move, not the column."""
    close = midnight(as_of) + cutoff - offset
    return (moment > instant(close - timedelta(days=1))) & (moment < instant(close))


def on_day_or_late(moment: Column, updated: Column, as_of, late_after: timedelta = timedelta(hours=9)) -> Column:
    """Dated on the day of ``as_of``, or dated earlier but updated after ``late_after`` on that day."""
    start = midnight(as_of)
    return same_day(moment, start) | ((moment < instant(start)) & (updated > instant(start + late_after)))
