"""Cohort retention and return visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _age(period: Column, first: Column, grain: str) -> Column:
    if grain == "day":
        return F.datediff(period, first)
    if grain == "week":
        return (F.datediff(period, first) / 7).cast("int")
    if grain == "month":
        return (F.year(period) - F.year(first)) * 12 + F.month(period) - F.month(first)
    raise ValueError(f"grain must be day, week or month, not {grain!r}")


def cohort_retention(
    df: DataFrame,
    user: str = "user_id",
    date: str = "event_date",
    grain: str = "month",
    max_age: int | None = None,
) -> DataFrame:
    """Active users per cohort and age: ``cohort_{grain}, {grain}s_since_cohort, active_users``.

    A user's cohort is the period of their first activity. Activity is first reduced to one
    row per user and period, so the per-user window sees at most one row per period. All ages
    are given unless ``max_age`` bounds them.
    """
    cohort, age = f"cohort_{grain}", f"{grain}s_since_cohort"
    period = F.to_date(F.col(date)) if grain == "day" else F.trunc(F.col(date), grain)
    active = df.select(F.col(user).alias("user"), period.alias("period")).distinct()
    first = F.min("period").over(W.partitionBy("user"))
    aged = active.select("user", "period", first.alias(cohort)).select(
        cohort, _age(F.col("period"), F.col(cohort), grain).alias(age)
    )
    if max_age is not None:
        aged = aged.filter(F.col(age) <= max_age)
    return aged.groupBy(cohort, age).agg(F.count(F.lit(1)).alias("active_users")).orderBy(cohort, age)


#: Months of a word of :func:`user_months`.
WORD = 64


def user_months(df: DataFrame, user: str = "user_id", date: str = "event_date") -> DataFrame:
    """(user, word, bits): the months a user was active in, as bits of words of 64 months.

    Parts made of different days are merged by :func:`merged_months`.
    """
    month = F.year(date) * 12 + F.month(date) - 1
    rows = df.select(F.col(user).alias("user"), month.alias("month")).where("month is not null")
    return rows.groupBy("user", F.floor(F.col("month") / WORD).cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, pmod(month, {WORD})))").alias("bits"))


def merged_months(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user", "word").agg(F.bit_or("bits").alias("bits"))


def cohorts_of_months(months: DataFrame) -> DataFrame:
    """:func:`cohort_retention` by month, all ages, of :func:`user_months`."""
    active = F.expr(f"filter(transform(sequence(0, {WORD - 1}), b -> if(shiftright(bits, b) & 1 = 1, "
                    f"word * {WORD} + b, null)), b -> b is not null)")
    rows = months.select("user", active.alias("months"))
    # A user of more than 64 months has several words.
    first = F.min(F.array_min("months")).over(W.partitionBy("user"))
    aged = rows.select(first.alias("first"), F.explode("months").alias("month"))
    cohort = F.make_date(F.floor(F.col("first") / 12).cast("int"), F.col("first") % 12 + 1, F.lit(1))
    return aged.groupBy(cohort.alias("cohort_month"), (F.col("month") - F.col("first")).alias("months_since_cohort")
                        ).agg(F.count(F.lit(1)).alias("active_users")).orderBy("cohort_month", "months_since_cohort")


def cohort_matrix(long: DataFrame, ages: Sequence[int] = range(13), grain: str = "month") -> DataFrame:
    """One row per cohort, one column ``age_{n}`` per age; null where there is no value.

    A cohort and age given twice is an error, as there is no single value for the cell.
    """
    cohort, age = f"cohort_{grain}", f"{grain}s_since_cohort"
    cell = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate cohort and age")).cast("long")
    ).otherwise(F.max("active_users"))
    cells = long.groupBy(cohort, age).agg(cell.alias("active_users"))
    wide = cells.groupBy(cohort).pivot(age, list(ages)).agg(F.first("active_users"))
    return wide.select(cohort, *[F.col(f"`{a}`").alias(f"age_{a}") for a in ages]).orderBy(cohort)


def retained_within(
    df: DataFrame,
    days: int = 7,
    user: str = "user_id",
    date: str = "event_date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per user and active day: did the user come back within ``days`` days?

    The last ``days`` days of the data are dropped, as their outcome is not known yet.
    ``keep`` names further columns of the grain, such as the user's tier. A day on which the
    user has two of them is one visit, so it is not its own return.
    """
    horizon = df.select(F.date_sub(F.max(date), days)).scalar()
    visits = df.select(user, date, *keep).distinct()
    # Ordered by day as a number, the frame starts at the next calendar day.
    day_number = F.unix_date(date)
    later = W.partitionBy(user).orderBy(day_number).rangeBetween(1, W.unboundedFollowing)
    next_visit = F.min(date).over(later)
    return (
        visits.withColumn("next_active", next_visit)
        .filter(F.col(date) <= horizon)
        .withColumn(
            "retained",
            F.coalesce(F.datediff("next_active", date) <= days, F.lit(False)).cast("int"),
        )
        .select(user, date, *keep, "retained")
    )
