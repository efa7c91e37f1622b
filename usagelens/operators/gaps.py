"""Which minute slots have events, which do not, and ids for the missing ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import dates
from usagelens.functions.numeric import ratio
from usagelens.functions.slot_ids import slot_event_id
from usagelens.operators.filters import time_range


def slot_window(as_of: dt.datetime, days: int = 90) -> tuple[dt.datetime, dt.datetime]:
    """Start and end of the ``days`` days up to the current minute, that minute included."""
    end = as_of.replace(second=0, microsecond=0) + dt.timedelta(minutes=1)
    return end - dt.timedelta(days=days), end


def slot_calendar(
    spark: SparkSession, start: dt.datetime, end: dt.datetime, every_seconds: int = 60
) -> DataFrame:
    """Every slot in ``[start, end)``, generated in parallel from a range of numbers."""
    seconds = (end - start).total_seconds()
    n = max(0, int(-(-seconds // every_seconds)))
    first = F.unix_micros(dates.instant(start))
    return spark.range(n).select(
        F.timestamp_micros(first + F.col("id") * F.lit(every_seconds * 1_000_000)).alias("slot")
    )


def slots_between(bounds: DataFrame, every_seconds: int = 60) -> DataFrame:
    """Every slot in ``[start, end)`` for a frame of one row with the columns ``start`` and ``end``.

    The row is fetched; the slots are a range of numbers, which Spark splits by itself.
    """
    start, end = bounds.select(F.unix_micros("start"), F.unix_micros("end")).first()
    if start is None or end is None:
        start = end = 0
    step = every_seconds * 1_000_000
    return bounds.sparkSession.range(max(0, -(-(end - start) // step))).select(
        F.timestamp_micros(F.lit(start) + F.col("id") * F.lit(step)).alias("slot"))


def existing_slots(df: DataFrame, start=None, end=None, ts: str = "timestamp") -> DataFrame:
    """Distinct minutes with at least one event, optionally only in ``[start, end)``."""
    if start is not None:
        df = time_range(df, start, end, ts)
    return df.select(dates.minute_slot(ts).alias("slot")).distinct()


def missing_slots(calendar: DataFrame, existing: DataFrame) -> DataFrame:
    """Slots of the calendar without an event, in order."""
    return calendar.join(existing, "slot", "left_anti").orderBy("slot")


def slot_coverage(calendar: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: expected, existing and missing slots."""
    flagged = calendar.join(existing.withColumn("hit", F.lit(1)), "slot", "left")
    expected, found = F.count(F.lit(1)), F.count("hit")
    return flagged.agg(
        expected.alias("expected"), found.alias("existing"), (expected - found).alias("missing")
    )


def backfill_keys(missing: DataFrame) -> DataFrame:
    """Missing slots with the id their backfilled event must carry."""
    return missing.withColumn("event_id", slot_event_id("slot"))


def append_events(backfill: DataFrame, top_up: DataFrame) -> DataFrame:
    """Backfilled and other new events as one batch, matched by column name."""
    return backfill.unionByName(top_up, allowMissingColumns=True)


def hourly_profile(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Measured traffic by hour of day, weekdays and weekends apart.

    ``days`` is the number of weekdays or weekend days from the first to the last day of the data,
    with or without traffic in that hour; an hour without any has a row with 0 requests. A kind of
    day that the span lacks has no rows.
    """
    hourly = df.groupBy(
        F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    span = hourly.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null")
    grid = (span.select(F.explode(F.sequence("first", "last")).alias("day"))
            .groupBy(dates.is_weekend("day").alias("is_weekend")).agg(F.count(F.lit(1)).alias("days"))
            .select("is_weekend", "days", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
    traffic = hourly.groupBy("hour", dates.is_weekend("day").alias("is_weekend")).agg(
        F.sum("n").alias("requests"))
    requests = F.coalesce("requests", F.lit(0))
    return (
        grid.join(traffic, ["hour", "is_weekend"], "left")
        .select("hour", "is_weekend", requests.alias("requests"), "days",
                ratio(requests, F.col("days")).alias("requests_per_day"))
        .orderBy("is_weekend", "hour")
    )
