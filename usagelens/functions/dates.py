"""Dates and time slots. ``as_of`` always comes from the caller, never from the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def days_before(as_of: dt.date | str, days: int) -> dt.date:
    """Calendar day ``days`` before ``as_of``."""
    return dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=days)


def instant(value: dt.datetime | dt.date | str) -> Column:
    """Literal timestamp in the session time zone."""
    return F.lit(str(value)).cast("timestamp")


def days_since(as_of: dt.date | str, column: str) -> Column:
    return F.datediff(day(as_of), F.col(column))


def minute_slot(column: str = "timestamp") -> Column:
    return F.date_trunc("minute", F.col(column))


def is_weekend(column: str) -> Column:
    # dayofweek counts from Sunday = 1.
    return F.dayofweek(column).isin(1, 7)
