"""Date and time expressions (Column -> Column).

Epoch values are milliseconds; conversions use the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PATTERN = "yyyy-MM-dd"


def millis_to_string(ms: Column, pattern: str, shift: str | None = None) -> Column:
    """Epoch millis as text; ``shift`` is an interval text such as ``-60 seconds``."""
    moment = F.timestamp_millis(ms)
    if shift:
        moment = moment + F.expr(f"INTERVAL '{shift}'")
    return F.date_format(moment, pattern)


def server_time_to_millis(seconds_text: Column) -> Column:
    """Seconds with a fraction, as text, to whole millis; -1 for anything else."""
    seconds = F.trim(seconds_text).try_cast("double")
    return F.coalesce((seconds * F.lit(1000)).try_cast("bigint"), F.lit(-1).cast("bigint"))


def is_valid_running_date(text: Column) -> Column:
    """Shape check only: four, two and two digits; the date need not exist."""
    return F.coalesce(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.lit(False))


def parse_date_string(text: Column, pattern: str = DATE_PATTERN) -> Column:
    """Text to epoch millis; text that does not fit the pattern is an error."""
    return F.unix_millis(F.to_timestamp(text, pattern))


def format_date(ms: Column, pattern: str = DATE_PATTERN) -> Column:
    return millis_to_string(ms, pattern)


def week_of_year(ts: Column) -> Column:
    """Weeks start on Sunday and week 1 is the one that holds January 1st.

    The last days of December therefore belong to week 1 when their week
    reaches into January; ``weekofyear`` counts ISO weeks and differs.
    """
    days_before_january_first = F.dayofweek(F.trunc(ts, "year")) - 1
    saturday = F.date_add(ts.cast("date"), 7 - F.dayofweek(ts))
    within = ((F.dayofyear(ts) - 1 + days_before_january_first) / 7).cast("int") + 1
    return F.when(F.year(saturday) > F.year(ts), F.lit(1)).otherwise(within)


_PARTS = {
    "year": F.year,
    "season": F.quarter,
    "month": F.month,
    "week": week_of_year,
    "day": F.dayofmonth,
    "hour": F.hour,
}


def date_part_of(ts: Column, part: str) -> Column:
    if part not in _PARTS:
        raise ValueError(f"unknown date part {part!r}; use one of {sorted(_PARTS)}")
    return _PARTS[part](ts)


def _sunday(ts: Column, weeks: int) -> Column:
    return F.date_add(ts.cast("date"), 1 - F.dayofweek(ts) + 7 * weeks)


def _first_of_month(ts: Column, months: int) -> Column:
    return F.add_months(F.trunc(ts, "month"), months)


_PERIODS = {
    "today": lambda ts: ts.cast("date"),
    "this_week": lambda ts: _sunday(ts, 0),
    "previous_week": lambda ts: _sunday(ts, -1),
    "next_week": lambda ts: _sunday(ts, 1),
    "this_month": lambda ts: _first_of_month(ts, 0),
    "previous_month": lambda ts: _first_of_month(ts, -1),
    "next_month": lambda ts: _first_of_month(ts, 1),
}


def period_starts(ts: Column, which: str, days: int = 0) -> Column:
    """First day of a period as a date (midnight); ``days`` moves it on or back."""
    if which not in _PERIODS:
        raise ValueError(f"unknown period {which!r}; use one of {sorted(_PERIODS)}")
    start = _PERIODS[which](ts)
    return F.date_add(start, days) if days else start


def yesterday(pattern: str = DATE_PATTERN) -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), pattern)
