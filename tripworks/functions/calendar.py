"""Calendar parts, cyclic encodings and holiday rules. Weekday 0 is Monday."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Rules as (month, first day, last day, weekday or None for any weekday).
HOLIDAY_RULES = (
    (1, 1, 1, None),
    (7, 4, 4, None),
    (11, 11, 11, None),
    (12, 25, 25, None),
    (1, 15, 21, 0),
    (2, 15, 21, 0),
    (5, 25, 31, 0),
    (9, 1, 7, 0),
    (10, 8, 14, 0),
    (11, 22, 28, 3),
)
HOLIDAY_EVE_RULES = (
    (12, 31, 31, None),
    (7, 3, 3, None),
    (11, 10, 10, None),
    (12, 24, 24, None),
    (1, 14, 20, 6),
    (2, 14, 20, 6),
    (5, 24, 30, 6),
    (9, 1, 6, 6),
    (8, 31, 31, 6),
    (10, 7, 13, 6),
    (11, 21, 27, 2),
)

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a UTC wall-clock timestamp (the session time zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(float(MICROS_PER_SECOND))


def week_hour(weekday: Column, hour: Column) -> Column:
    return weekday * 24 + hour


def is_weekend(weekday: Column, weekend_days: tuple[int, ...] = (0, 6)) -> Column:
    """1 on the given weekdays. The default, Monday and Sunday, is what the feature is defined on."""
    return weekday.isin(*weekend_days).cast("int")


def week_position(weekday: Column, hour: Column, minute: Column) -> Column:
    """Days since the start of the week, with a fraction for the time of day."""
    return weekday + (hour + minute / F.lit(60.0)) / F.lit(24.0)


def half_wave(position: Column, period: float) -> Column:
    """Sine over half a turn per period, so both ends of a period are near 0 and the middle is 1."""
    return F.sin(position / F.lit(float(period)) * F.pi())


def round_to_hour(ts: Column) -> Column:
    """Nearest full hour; half past goes to the even hour since the epoch."""
    hours = F.bround(epoch_micros(ts) / F.lit(float(3600 * MICROS_PER_SECOND)))
    return F.timestamp_seconds(hours * 3600).cast("timestamp_ntz")


def is_midnight(hour: Column) -> Column:
    return F.coalesce(hour.between(0, 5).cast("int"), F.lit(0))


def _matches(rules, month: Column, day: Column, weekday: Column) -> Column:
    def one(rule):
        rule_month, first, last, rule_weekday = rule
        hit = (month == rule_month) & day.between(first, last)
        return hit if rule_weekday is None else hit & (weekday == rule_weekday)

    return F.coalesce(reduce(or_, map(one, rules)).cast("int"), F.lit(0))


def is_holiday(month: Column, day: Column, weekday: Column) -> Column:
    return _matches(HOLIDAY_RULES, month, day, weekday)


def is_holiday_eve(month: Column, day: Column, weekday: Column) -> Column:
    return _matches(HOLIDAY_EVE_RULES, month, day, weekday)


def day_month_date(text: Column, year: int | None = None) -> Column:
    """Date from ``d-m-yyyy`` text, or NULL if it is none. ``year`` takes the place of the text's own."""
    if year is not None:
        text = F.regexp_replace(text, "-[^-]*$", f"-{year}")
    return F.try_to_date(text, "d-M-yyyy")
