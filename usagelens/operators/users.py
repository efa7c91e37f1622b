"""Tables with one row per user."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import dates
from usagelens.functions.numeric import to_number
from usagelens.operators import measures as m
from usagelens.schema import USER_TIERS

ACTIVITY_FEATURES = [
    "total_requests", "avg_latency", "error_count", "active_days", "total_tokens",
    "days_since_last",
]


def _activity(df: DataFrame) -> dict[str, Column]:
    return {
        "last_active": F.max("event_date"),
        "total_requests": m.requests(df),
        "avg_latency": m.mean_latency(df),
        "error_count": m.errors(df),
        "active_days": F.countDistinct("event_date"),
        "total_tokens": m.tokens(),
        "churn_day": F.max("churn_day"),
    }


def user_activity(df: DataFrame) -> DataFrame:
    """Totals per user."""
    return df.groupBy("user_id").agg(*[c.alias(n) for n, c in _activity(df).items()])


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """Add ``{prefix}_{value}`` with 0 or 1 for each of ``values``, in alphabetical order."""
    return df.withColumns({
        f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
        for v in sorted(values)
    })


def churned(as_of: dt.date | str) -> Column:
    """1 if the user has been away for longer than their churn day says."""
    away = dates.days_since(as_of, "last_active")
    return F.when(F.col("churn_day").isNotNull() & (away > F.col("churn_day")), 1).otherwise(0)


def churn_features(
    df: DataFrame, as_of: dt.date | str, tiers: Sequence[str] = USER_TIERS
) -> DataFrame:
    """User totals, latest tier, days since last activity, the churn label and tier columns.

    Totals and latest tier come out of one aggregation over the user-day rollup, so the two
    need no join and the events are read once. The tier of the last event counts; of several at one
    instant, the last by name.
    """
    rollup = df if m.is_rollup(df) else m.user_days(df)
    latest = F.max(F.struct("event_date", m.last_seen(rollup), "user_tier"))
    users = rollup.groupBy("user_id").agg(
        *[c.alias(n) for n, c in _activity(rollup).items()], latest.alias("_latest")
    )
    users = users.withColumns({
        "user_tier": F.col("_latest.user_tier"),
        "days_since_last": dates.days_since(as_of, "last_active"),
        "churned": churned(as_of),
    }).drop("_latest")
    return one_hot(users.na.fill(0, subset=ACTIVITY_FEATURES), "user_tier", tiers, "tier")


def feature_columns(tiers: Sequence[str] = USER_TIERS) -> list[str]:
    return [*ACTIVITY_FEATURES, *[f"tier_{t}" for t in sorted(tiers)]]


def user_lifetimes(
    df: DataFrame, as_of: dt.date | str, inactive_days: int = 30
) -> DataFrame:
    """First and last activity per user and tier; churned means inactive for longer.

    A user who changed tier appears once per tier.
    """
    spans = df.groupBy("user_id", "user_tier").agg(
        F.min("event_date").alias("acquisition_date"), F.max("event_date").alias("last_active")
    )
    still_there = F.col("last_active") >= F.lit(dates.days_before(as_of, inactive_days))
    return spans.withColumns({
        "churned": F.when(still_there, 0).otherwise(1),
        "lifetime_days": F.datediff("last_active", "acquisition_date") + 1,
    })


def numeric_durations(df: DataFrame, column: str = "lifetime_days") -> DataFrame:
    """Durations as numbers; rows whose duration is missing or not a number are dropped."""
    return df.withColumn(column, to_number(column)).na.drop(subset=[column])


def at_risk(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` users longest without activity."""
    return (
        df.groupBy("user_id", "user_tier")
        .agg(m.requests(df).alias("requests"), F.max("event_date").alias("last_active"))
        .orderBy("last_active", "user_id", "user_tier")
        .limit(n)
    )
