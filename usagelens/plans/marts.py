"""Materialized tables: the staged events as a view, everything derived as Parquet tables."""

from __future__ import annotations

import datetime as dt
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import dates
from usagelens.operators.cohorts import cohorts_of_months, merged_months, user_months
from usagelens.operators.histograms import latency_parts
from usagelens.operators.measures import user_days
from usagelens.operators.quality import Check, check_rows, in_set, not_null, unique
from usagelens.plans import reports
from usagelens.schema import ENDPOINTS, USER_TIERS
from usagelens.session import materialize, path_exists, scratch

STAGING_VIEW = "stg_api_events"
ROLLUP = "user_days"

# Stored beside the marts, for their next refresh: counts by day and endpoint, and months of users.
PARTS = "endpoint_parts"
MONTHS = "user_months"


def endpoint_parts(events: DataFrame) -> DataFrame:
    """Counts by day and endpoint: of latencies by bucket, and the users."""
    return latency_parts(events, ["event_date", "endpoint"])


# Tables with one partition per day, which can be refreshed for recent days only.
DAILY_FROM_EVENTS = {ROLLUP: user_days, "daily_errors": reports.daily_errors}
DAILY = DAILY_FROM_EVENTS | {PARTS: endpoint_parts}
# Marts that the much smaller rollup is enough for.
FROM_ROLLUP = {
    "dau": reports.dau,
    "token_usage": reports.token_usage,
    "user_tiers": reports.user_tiers,
    "daily_latency_error": reports.daily_latency_error,
}
# Marts that follow from what is stored beside.
FROM_PARTS = ("endpoints", "cohort_retention")

MART_CHECKS: dict[str, list[Check]] = {
    "dau": [not_null("event_date"), unique("event_date"), not_null("dau")],
    "endpoints": [not_null("endpoint"), unique("endpoint"), in_set("endpoint", ENDPOINTS)],
    "user_tiers": [not_null("user_tier"), unique("user_tier"), in_set("user_tier", USER_TIERS)],
    ROLLUP: [not_null("event_date"), not_null("user_id"), in_set("user_tier", USER_TIERS)],
    "daily_errors": [not_null("event_date"), in_set("endpoint", ENDPOINTS)],
    "token_usage": [not_null("event_date"), in_set("user_tier", USER_TIERS)],
    "daily_latency_error": [not_null("event_date"), unique("event_date"), not_null("avg_latency")],
    "cohort_retention": [not_null("cohort_month"), not_null("active_users")],
}


def _write_days(df: DataFrame, path: str, keep_other_days: bool) -> None:
    # Rebalancing splits a day with a third of all rows and merges small ones.
    rows = df.hint("rebalance", F.col("event_date"))
    overwrite = "dynamic" if keep_other_days else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(
        "event_date").parquet(path)


def build_marts(
    spark: SparkSession, staged: DataFrame, out: str, since: dt.date | str | None = None
) -> dict[str, str]:
    """Write all marts below ``out`` and register the staging view; gives the path of each.

    The events are read for the three daily tables: the rollup, the errors, and the counts by endpoint.
    Other marts come from those, but for the values near each endpoint's percentile, which are read on
    the days that have some. With ``since`` only the days from then on are read and written again in
    the daily tables; their months are added to those known of each user, so no old day is read for
    the cohorts either. A user's month stays even if its events go; a full build forgets it.
    """
    staged.createOrReplaceTempView(STAGING_VIEW)
    paths = {name: os.path.join(out, name) for name in [*DAILY, *FROM_ROLLUP, *FROM_PARTS, MONTHS]}
    recent = staged if since is None else staged.filter(F.col("event_date") >= dates.day(since))
    for name, build in DAILY.items():
        _write_days(build(recent), paths[name], keep_other_days=since is not None)

    def daily(name: str) -> DataFrame:
        return spark.read.schema(DAILY[name](staged).schema).parquet(paths[name])

    for name, build in FROM_ROLLUP.items():
        build(daily(ROLLUP)).write.mode("overwrite").parquet(paths[name])
    reports.endpoint_metrics(staged, parts=daily(PARTS)).write.mode("overwrite").parquet(paths["endpoints"])
    with scratch(spark):
        _write_months(spark, daily(ROLLUP), paths[MONTHS], since)
    cohorts_of_months(spark.read.parquet(paths[MONTHS])).write.mode("overwrite").parquet(paths["cohort_retention"])
    return {name: path for name, path in paths.items() if name not in (PARTS, MONTHS)}


def _write_months(spark: SparkSession, rollup: DataFrame, path: str, since: dt.date | str | None) -> None:
    """Merge the months of recent days into the stored ones, where those are whole."""
    if since is not None and path_exists(spark, os.path.join(path, "_SUCCESS")):
        fresh = user_months(rollup.filter(F.col("event_date") >= dates.day(since)))
        months = materialize(merged_months(fresh.unionByName(spark.read.schema(fresh.schema).parquet(path))), "months")
    else:
        months = user_months(rollup)
    months.write.mode("overwrite").parquet(path)


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """Check results of all given marts, with the mart's name; a failure does not stop the run.

    Give the stored tables, as each kind of check reads its mart. A mart without checks is an error.
    """
    if unknown := set(marts) - set(MART_CHECKS):
        raise ValueError(f"no checks for {sorted(unknown)}")
    parts = [check_rows(marts[name], MART_CHECKS[name]).select(F.lit(name).alias("mart"), "*")
             for name in sorted(marts)]
    return reduce(DataFrame.unionByName, parts)
