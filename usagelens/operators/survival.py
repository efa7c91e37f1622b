"""Kaplan-Meier survival curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def kaplan_meier(
    df: DataFrame, group: str = "user_tier", duration: str = "lifetime_days", event: str = "churned"
) -> DataFrame:
    """Survival curve per group: ``{group}, timeline, at_risk, events, survival_prob``.

    ``event`` is 1 where the end was observed and 0 where the subject was still there
    (censored). Every duration seen is a point, after a first one at 0 with survival 1. A
    group of one subject gives no curve. Subjects are first counted per group and duration,
    so the windows run over distinct durations only.
    """
    points = (
        df.filter(F.col(duration).isNotNull())
        .groupBy(group, F.col(duration).cast("double").alias("timeline"))
        .agg(F.count(F.lit(1)).alias("leaving"), F.sum(F.col(event).cast("long")).alias("events"))
    )
    size = F.sum("leaving").over(W.partitionBy(group))
    by_time = W.partitionBy(group).orderBy("timeline")
    at_risk = F.sum("leaving").over(by_time.rowsBetween(W.currentRow, W.unboundedFollowing))
    points = points.withColumns({"size": size, "at_risk": at_risk}).filter(F.col("size") > 1)

    # The product takes a factor 0, when the last subjects at risk all end, as it is.
    surviving = F.product(1 - F.col("events") / F.col("at_risk")).over(
        by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    first = F.min("timeline").over(W.partitionBy(group))
    curve = points.withColumns({"survival_prob": surviving, "first": first})
    # The first time of a curve also opens it, unless a subject was already seen at time 0.
    opens = (F.col("timeline") == F.col("first")) & (F.col("timeline") > 0)
    start = F.struct(
        F.lit(0.0).alias("timeline"), F.col("size").alias("at_risk"),
        F.lit(0).cast("long").alias("events"), F.lit(1.0).alias("survival_prob"),
    )
    point = F.struct("timeline", "at_risk", "events", "survival_prob")
    rows = curve.select(group, F.explode(F.when(opens, F.array(start, point)).otherwise(F.array(point))).alias("p"))
    return rows.select(group, "p.*").orderBy(group, "timeline")
