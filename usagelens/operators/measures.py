"""One set of measures that reads raw staged events and the user-day rollup alike.

The rollup holds one row per user, day and tier, so everything keyed by user, day or tier can
be computed from it instead of from the events: a full scan of the events is paid once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import ratio

ROLLUP_KEYS = ("event_date", "user_id", "user_tier", "region")


# What :func:`user_days` adds and staged events do not have.
ROLLUP_COLUMNS = frozenset({
    "request_count", "error_count", "latency_total", "latency_count", "last_timestamp"})


def is_rollup(df: DataFrame) -> bool:
    """Is this the rollup? It has all of its columns; events with a ``request_count`` of their own
    are still events."""
    return ROLLUP_COLUMNS <= set(df.columns)


def user_days(df: DataFrame, keys: tuple[str, ...] = ROLLUP_KEYS) -> DataFrame:
    """Roll staged events up to one row per ``keys``.

    Every aggregate is a plain sum, count or max over fixed-width values, so the rows are
    combined in hash maps before the shuffle and a very busy user costs one row per task.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if("is_error").alias("error_count"),
        F.sum("latency_ms").alias("latency_total"),
        F.count("latency_ms").alias("latency_count"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.max("timestamp").alias("last_timestamp"),
        F.max("churn_day").alias("churn_day"),
    )


def requests(df: DataFrame) -> Column:
    return F.sum("request_count") if is_rollup(df) else F.count(F.lit(1))


def errors(df: DataFrame) -> Column:
    return F.sum("error_count") if is_rollup(df) else F.count_if("is_error")


def error_ratio(df: DataFrame) -> Column:
    return ratio(errors(df), requests(df))


def mean_latency(df: DataFrame) -> Column:
    if is_rollup(df):
        return ratio(F.sum("latency_total"), F.sum("latency_count"))
    return F.avg("latency_ms")


def users() -> Column:
    return F.countDistinct("user_id")


def tokens(column: str = "total_tokens") -> Column:
    return F.sum(column)


def last_seen(df: DataFrame) -> str:
    return "last_timestamp" if is_rollup(df) else "timestamp"
