"""Counts of requests by latency bucket, and of users, which can be stored by day and merged.

One scan of the events gives both. From the buckets follow all sums, and in which bucket a percentile
lies; only the events of that bucket are then looked at, on the days that have it and between the least
and the greatest value counted in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import half_up, percent, ratio
from usagelens.operators.rank_select import COARSE, located_ranks, magnitude_bucket, percentile_near

SUMS = ("requests", "error_count", "latency_rows", "latency_total", "tokens")


def latency_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per ``keys``: a row for each latency bucket, and one for each user (``of_user``).

    Rows without a latency have the bucket null. Both kinds come from one scan of the staged events,
    combined before the shuffle.
    """
    value = F.col("latency_ms").cast("double")
    rows = df.select(*keys, F.col("user_id").alias("user"), "is_error", "total_tokens", value.alias("value"),
                     magnitude_bucket(value, COARSE).alias("bucket"))
    return rows.groupingSets([[*keys, "bucket"], [*keys, "user"]], *keys, "bucket", "user").agg(
        (F.grouping("user") == 0).alias("of_user"),
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("error_count"),
        F.count("value").alias("latency_rows"),
        F.sum("value").alias("latency_total"),
        F.sum("total_tokens").alias("tokens"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def part_totals(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests, errors, mean latency, tokens and distinct users per ``keys`` of merged parts."""
    sums = [F.sum(F.when(~F.col("of_user"), F.col(c))).alias(c) for c in SUMS]
    users = F.countDistinct(F.when(F.col("of_user"), F.col("user"))).alias("users")
    rows = parts.groupBy(*keys).agg(*sums, users)
    return rows.withColumns({
        "requests": F.coalesce("requests", F.lit(0)),
        "error_ratio": ratio("error_count", "requests"),
        "error_pct": percent("error_count", "requests"),
        "avg_latency": half_up(ratio("latency_total", "latency_rows"), 1),
    })


def part_percentile(parts: DataFrame, events: DataFrame, keys: Sequence[str], p: float, name: str) -> DataFrame:
    """Exact percentile of the latency per ``keys``; ``parts`` count the latencies of ``events``.

    With days in the parts, which then also are a column of the events, the days without a wanted bucket
    are not read. A bucket of one value needs no events at all.
    """
    keys = list(keys)
    buckets = parts.where("not of_user and latency_rows > 0").withColumnRenamed("bucket", "_bucket")
    counted = buckets.groupBy(*keys, "_bucket").agg(
        F.sum("latency_rows").alias("_rows"), F.min("low").alias("_least"), F.max("high").alias("_most"))
    located = located_ranks(counted, keys, p)
    value = F.col("latency_ms").cast("double")
    rows = events
    if "event_date" in parts.columns and "event_date" not in keys:
        same = located.drop("_rows").alias("l")
        wide = buckets.alias("b").join(same, [F.col(f"b.{c}").eqNullSafe(F.col(f"l.{c}")) for c in [*keys, "_bucket"]])
        span = wide.where("l._least < l._most").agg(
            F.collect_set("b.event_date").alias("days"), F.min("l._least").alias("low"),
            F.max("l._most").alias("high")).first()
        rows = events.where(F.col("event_date").isin(span["days"]))
        if span["low"] is not None:
            rows = rows.where(F.col("latency_ms").between(F.lit(span["low"]), F.lit(span["high"])))
    rows = rows.select(*keys, value.alias("_value"), magnitude_bucket(value, COARSE).alias("_bucket"))
    # NaN equals itself here, and has a bucket of its own.
    single = located.where("_least = _most").withColumn("_value", F.col("_least"))
    return percentile_near(rows.where("_value is not null"), located, keys, name, known=single)
