"""Epoch milliseconds, calendar dates and their parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def event_date(epoch_ms: Column) -> Column:
    """Calendar date of an event in the session time zone."""
    return F.to_date(F.timestamp_millis(epoch_ms))


# last millisecond of the year 9999: later numbers are no calendar time
LAST_MS = 253_402_300_799_999


def is_calendar_ms(epoch_ms: Column) -> Column:
    """Whether a number of epoch milliseconds is a time from 1970 to 9999; NULL is not."""
    return F.coalesce(epoch_ms.between(0, LAST_MS), F.lit(False))


def format_epoch(epoch_ms: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(epoch_ms), pattern)


def parse_epoch(text: Column, pattern: str) -> Column:
    """Text to epoch milliseconds in the session time zone; NULL if it does not parse."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def day_start(day: Column) -> Column:
    """First epoch millisecond of a date in the session time zone."""
    return F.unix_millis(day.cast("timestamp"))


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def is_valid_date(text: Column) -> Column:
    """Exactly yyyy-MM-dd and a real calendar day, year 0000 excluded."""
    # to_date accepts a year beyond 4 digits or a sign, hence the shape test
    return F.coalesce(
        text.rlike(r"\A\d{4}-\d{2}-\d{2}\z")
        & (F.substring(text, 1, 4) != "0000")
        & F.try_to_date(text, "yyyy-MM-dd").isNotNull(),
        F.lit(False),
    )


def date_parts(day: Column) -> dict[str, Column]:
    """year, season (quarter), month, ISO week, day of month."""
    return {
        "year": F.year(day),
        "season": F.quarter(day),
        "month": F.month(day),
        "week": F.weekofyear(day),
        "day": F.dayofmonth(day),
    }


def checked_date(text: str) -> dt.date:
    """A job's date argument; the same rule as ``is_valid_date``, for one value."""
    try:
        day = dt.datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError):
        day = None
    if day is None or day.isoformat() != text:
        raise ValueError(f"not a yyyy-MM-dd calendar date: {text!r}")
    return day
