"""Reports over staged events. Those keyed by day, tier or user also take the user-day rollup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import half_up, percent
from usagelens.operators import measures as m
from usagelens.operators.cohorts import cohort_retention
from usagelens.operators.filters import last_days, latest_day
from usagelens.operators.histograms import latency_parts, part_percentile, part_totals
from usagelens.operators.rolling import rolling
from usagelens.session import materialize

P95 = 0.95


def _latest_day_metrics(df: DataFrame, approx: bool, parts: DataFrame | None = None) -> DataFrame:
    """One row, also for an empty table; ``parts``: stored :func:`latency_parts` by day."""
    day = latest_day(df)
    if approx:
        return day.agg(
            F.max("event_date").alias("event_date"),
            F.approx_count_distinct("user_id").alias("users"), m.requests(day).alias("requests"),
            m.error_ratio(day).alias("error_ratio"), half_up(m.mean_latency(day), 1).alias("avg_latency"),
            m.tokens().alias("tokens"), _approx_p95())
    if parts is None:
        parts = materialize(latency_parts(day, ["event_date"]), "latency-parts")
    else:
        parts = latest_day(parts)
    newest = parts.agg(F.max("event_date").alias("event_date"))
    # One row that is there without any rows too.
    totals = part_totals(parts.drop("event_date"), [])
    p95 = part_percentile(parts, day, ["event_date"], P95, "p95")
    return newest.join(p95, "event_date", "left").crossJoin(F.broadcast(totals)).withColumn(
        "p95_latency", half_up("p95", 1))


def _approx_p95():
    value = F.percentile_approx(F.col("latency_ms").cast("double"), P95, 10_000)
    return half_up(value, 1).alias("p95_latency")


def current_metrics(df: DataFrame, approx: bool = False, parts: DataFrame | None = None) -> DataFrame:
    """Key figures of the newest day; the error rate is a fraction.

    The day is scanned once for counts and sums, which are stored, and once for the values near the
    percentile. ``parts`` are the stored counts of a mart; then only the second scan is left.
    """
    return _latest_day_metrics(df, approx, parts).select(
        F.col("users").alias("dau"), "requests", half_up("error_ratio", 4).alias("error_rate"),
        "avg_latency", "p95_latency", "tokens",
    )


def narrative_metrics(df: DataFrame, approx: bool = False, parts: DataFrame | None = None) -> DataFrame:
    """Key figures of the newest day for the summary; the error rate is in percent."""
    return _latest_day_metrics(df, approx, parts).select(
        F.col("users").alias("dau"), F.col("requests").alias("total_requests"),
        half_up(F.col("error_ratio") * 100, 2).alias("error_rate"),
        "avg_latency", "p95_latency",
    )


# Fixed value: the labels of the summary.
SUMMARY = (
    "Platform Health Summary:\n"
    "- DAU: %s\n"
    "- Requests: %s\n"
    "- Error Rate: %.2f%%\n"
    "- Avg Latency: %.1fms\n"
    "- P95 Latency: %.1fms\n"
    "%s"
)


def narrative(df: DataFrame, max_error_rate: float = 5.0, max_p95_latency: float = 1_000.0,
              parts: DataFrame | None = None) -> DataFrame:
    """The key figures as a text, in one row; it ends with those above their limits (percent, ms)."""
    above = F.concat_ws(
        " and ",
        F.when(F.col("error_rate") > max_error_rate, "error rate"),
        F.when(F.col("p95_latency") > max_p95_latency, "P95 latency"))
    conclusion = F.when(above == "", "No figure is above its limit.").otherwise(
        F.concat(F.lit("Above its limit: "), above, F.lit(".")))
    return narrative_metrics(df, parts=parts).select(
        F.format_string(
            SUMMARY,
            F.format_number("dau", 0),
            F.format_number("total_requests", 0),
            "error_rate", "avg_latency", "p95_latency", conclusion,
        ).alias("narrative")
    )


def time_series(df: DataFrame, as_of: dt.date | str, days: int = 30) -> DataFrame:
    """Daily series of the last ``days`` days."""
    recent = last_days(df, as_of, days)
    return recent.groupBy("event_date").agg(
        m.requests(recent).alias("requests"),
        m.users().alias("users"),
        half_up(m.mean_latency(recent), 1).alias("avg_latency"),
        percent(m.errors(recent), m.requests(recent)).alias("error_pct"),
        m.tokens().alias("tokens"),
    ).orderBy("event_date")


def endpoint_metrics(df: DataFrame, approx: bool = False, parts: DataFrame | None = None) -> DataFrame:
    """Traffic, latency, errors and users per endpoint, busiest first.

    The events are read twice: for counts and sums, which are stored, and for the values near the
    percentile. ``parts`` are the stored counts by day of a mart; then only the days that have the
    percentile's bucket are read, and of them the values between its ends.
    """
    columns = ["endpoint", "requests", "avg_latency", "p95_latency", "error_pct", "users"]
    if approx:
        rows = df.groupBy("endpoint").agg(
            m.requests(df).alias("requests"),
            half_up(m.mean_latency(df), 1).alias("avg_latency"),
            percent(m.errors(df), m.requests(df)).alias("error_pct"),
            F.approx_count_distinct("user_id").alias("users"), _approx_p95())
        return rows.select(*columns).orderBy(F.desc("requests"), "endpoint")
    if parts is None:
        parts = materialize(latency_parts(df, ["endpoint"]), "latency-parts")
    p95 = part_percentile(parts, df, ["endpoint"], P95, "p95").withColumnRenamed("endpoint", "of")
    totals = part_totals(parts, ["endpoint"])
    rows = totals.join(p95, F.col("endpoint").eqNullSafe(F.col("of")), "left")
    return rows.withColumn("p95_latency", half_up("p95", 1)).select(*columns).orderBy(
        F.desc("requests"), "endpoint")


def user_tiers(df: DataFrame) -> DataFrame:
    """Users, traffic, latency and errors per tier, most users first."""
    return df.groupBy("user_tier").agg(
        m.users().alias("users"),
        m.requests(df).alias("requests"),
        half_up(m.mean_latency(df), 1).alias("avg_latency"),
        percent(m.errors(df), m.requests(df)).alias("error_pct"),
    ).orderBy(F.desc("users"), "user_tier")


def errors_top(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent kinds of error, with the users they hit."""
    keys = ["endpoint", "error_type", "status_code"]
    return (
        df.filter("is_error")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"), m.users().alias("users"))
        .orderBy(F.desc("count"), *keys)
        .limit(n)
    )


def dau(df: DataFrame) -> DataFrame:
    """Daily active users."""
    return df.groupBy("event_date").agg(m.users().alias("dau")).orderBy("event_date")


def token_usage(df: DataFrame) -> DataFrame:
    """Tokens per day and tier, in total and per active user."""
    return df.groupBy("event_date", "user_tier").agg(
        m.tokens("input_tokens").alias("input_tokens"),
        m.tokens("output_tokens").alias("output_tokens"),
        m.tokens().alias("total_tokens"),
        m.users().alias("users"),
        half_up(m.tokens() / m.users(), 2).alias("tokens_per_user"),
    ).orderBy("event_date", "user_tier")


def cohort_report(df: DataFrame, max_age: int = 12, **columns: str) -> DataFrame:
    """Cohort retention up to an age; the mart has all ages."""
    return cohort_retention(df, max_age=max_age, **columns)


def daily_errors(df: DataFrame) -> DataFrame:
    """Errors per day and endpoint."""
    return df.groupBy("event_date", "endpoint").agg(
        m.requests(df).alias("requests"),
        m.errors(df).alias("error_count"),
        percent(m.errors(df), m.requests(df)).alias("error_pct"),
    ).orderBy("event_date", "endpoint")


def daily_tier_panel(df: DataFrame) -> DataFrame:
    """Active users and tokens per day and tier."""
    return df.groupBy("event_date", "user_tier").agg(
        m.users().alias("active_users"), m.tokens().alias("tokens")
    )


def daily_latency_error(df: DataFrame) -> DataFrame:
    """Mean latency and error rate per day, unrounded."""
    return df.groupBy("event_date").agg(
        m.mean_latency(df).alias("avg_latency"),
        m.errors(df).alias("error_count"),
        m.requests(df).alias("total_requests"),
        m.error_ratio(df).alias("error_rate"),
    ).orderBy("event_date")


ROLLING_INPUTS = {"avg_latency": "latency", "error_rate": "error"}


def rolling_daily(df: DataFrame, n: int = 7) -> DataFrame:
    """The daily latency and error series with its rolling means and deviations."""
    return rolling(daily_latency_error(df), ROLLING_INPUTS, n)


def anomaly_columns(n: int = 7) -> list[str]:
    return [*ROLLING_INPUTS, f"latency_ma{n}", f"error_ma{n}", f"latency_std{n}", f"error_std{n}"]


def anomaly_features(df: DataFrame, n: int = 7) -> DataFrame:
    """Model input per day; days before the first full window are dropped."""
    columns = anomaly_columns(n)
    return rolling_daily(df, n).na.drop(subset=columns).select("event_date", *columns)
