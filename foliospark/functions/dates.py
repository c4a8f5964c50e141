"""Date texts, reading spans and recency."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.settings import MAX_READING_DAYS, MIN_READING_DAYS

ACTIVITY_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"
_WEEKDAY = "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) "


def activity_time(text: Column) -> Column:
    """Parse ``Sat Nov 01 12:30:00 +0000 2025``; anything else is NULL.

    The parser takes no weekday names, so the name is checked apart and cut off.
    """
    parsed = F.try_to_timestamp(F.substring(text, 5, 64), F.lit("MMM dd HH:mm:ss Z yyyy"))
    return F.when(text.rlike(_WEEKDAY), parsed)


def any_time(text: Column) -> Column:
    """``activity_time``, or the ISO-like text that the event migration writes."""
    return F.coalesce(activity_time(text), text.try_cast("timestamp"))


def activity_text(ts: Column) -> Column:
    return F.date_format(ts, ACTIVITY_FORMAT)


def instant_text(ts: Column) -> Column:
    """UTC instant as text, with microseconds."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00"))


def reading_days(started: Column, finished: Column) -> Column:
    """Whole days between two instants when within the plausible range, else NULL."""
    days = F.datediff(F.to_date(finished), F.to_date(started))
    return F.when(days.between(MIN_READING_DAYS, MAX_READING_DAYS), days)


def days_since(as_of: dt.date, moment: Column, default: int) -> Column:
    return F.coalesce(F.datediff(F.lit(as_of), F.to_date(moment)), F.lit(default))


def long_date(ts: Column) -> Column:
    return F.date_format(ts, "EEEE, MMMM dd yyyy")
