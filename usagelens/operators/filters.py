"""Row filters shared by the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.functions import dates


def latest_day(df: DataFrame, date: str = "event_date") -> DataFrame:
    """Rows of the newest day; over a partitioned table the rest is not read."""
    newest = df.select(F.max(date)).scalar()
    return df.filter(F.col(date) == newest)


def last_days(
    df: DataFrame, as_of: dt.date | str, days: int, date: str = "event_date"
) -> DataFrame:
    """Rows from ``days`` days before ``as_of`` on, that day included."""
    return df.filter(F.col(date) >= F.lit(dates.days_before(as_of, days)))


def time_range(df: DataFrame, start, end, ts: str = "timestamp") -> DataFrame:
    """Rows in ``[start, end)``."""
    inside = (F.col(ts) >= dates.instant(start)) & (F.col(ts) < dates.instant(end))
    if "event_date" in df.columns:
        # Stated again on the partition column, so that whole days are skipped.
        inside = (
            inside
            & (F.col("event_date") >= dates.instant(start).cast("date"))
            & (F.col("event_date") <= dates.instant(end).cast("date"))
        )
    return df.filter(inside)


def newest(df: DataFrame, n: int = 10_000, ts: str = "timestamp", key: str = "event_id") -> DataFrame:
    """The ``n`` newest rows, ties broken by key."""
    return df.orderBy(F.desc(ts), F.desc(key)).limit(n)


def newest_of_days(
    df: DataFrame, n: int = 10_000, ts: str = "timestamp", key: str = "event_id", date: str = "event_date"
) -> DataFrame:
    """:func:`newest` of a table with a folder per day: the days from the newest on that have ``n`` rows.

    Counting by day reads no column, and the day found prunes the folders while the query runs.
    """
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("n")).where(F.col(date).isNotNull())
    up_to = F.sum("n").over(W.orderBy(F.desc(date)))
    # Without enough rows there is no such day, and all are read.
    enough = days.select(date, up_to.alias("n")).where(F.col("n") >= n).agg(F.max(date)).scalar()
    first = F.coalesce(enough, F.lit("0001-01-01").cast("date"))
    return newest(df.filter(F.col(date) >= first), n, ts, key)


def mark_partial(daily: DataFrame, as_of: dt.date | str, date: str = "event_date") -> DataFrame:
    """Flag days still in progress, and the last complete day that a chart joins them to.

    Expects one row per day.
    """
    partial = F.col(date) >= dates.day(as_of)
    # One window over the days, so that the series is not computed twice.
    last_complete = F.max(F.when(~partial, F.col(date))).over(W.partitionBy())
    return daily.withColumns({
        "is_partial": partial,
        "is_bridge": F.coalesce(F.col(date) == last_complete, F.lit(False)),
    })
