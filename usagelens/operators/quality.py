"""Data-quality checks, evaluated together in as few passes as they allow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import percent
from usagelens.operators.filters import newest
from usagelens.schema import ALLOWED_STATUS_CODES, ENDPOINTS, USER_TIERS


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    column: str
    values: tuple = field(default=())


def not_null(column: str) -> Check:
    return Check(f"{column} not null", "not_null", column)


def unique(column: str) -> Check:
    """Every row whose value occurs more than once is unexpected; nulls are left out."""
    return Check(f"{column} unique", "unique", column)


def in_set(column: str, values: Sequence) -> Check:
    return Check(f"{column} in set", "in_set", column, tuple(values))


def between(column: str, low, high) -> Check:
    """Both ends are allowed."""
    return Check(f"{column} in range", "between", column, (low, high))


def mean_between(column: str, low, high) -> Check:
    return Check(f"{column} mean in range", "mean_between", column, (low, high))


# The default checks of the event table and their bounds.
EVENT_CHECKS = [
    not_null("event_id"),
    unique("event_id"),
    not_null("user_id"),
    in_set("user_tier", USER_TIERS),
    in_set("status_code", ALLOWED_STATUS_CODES),
    between("latency_ms", 0, 30000),
    mean_between("input_tokens", 100, 5000),
    in_set("endpoint", ENDPOINTS),
]


def _row_check(check: Check) -> tuple[Column, Column]:
    """Unexpected rows, and the rows they are a share of."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(value.isNull()), F.count(F.lit(1))
    if check.kind == "in_set":
        return F.count_if(~value.isin(*check.values)), F.count(value)
    if check.kind == "between":
        return F.count_if(~value.between(*check.values)), F.count(value)
    raise ValueError(f"unknown check {check.kind!r}")


def _result(position: int, check: Check, unexpected: Column, share_of: Column, evaluated: Column,
            passed: Column | None = None) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.name).alias("expectation"),
        (unexpected == 0 if passed is None else passed).alias("passed"),
        F.coalesce(percent(unexpected, share_of), F.lit(0.0)).alias("unexpected_pct"),
        evaluated.alias("evaluated_count"),
    )


def check_rows(
    df: DataFrame, checks: Sequence[Check] = EVENT_CHECKS, narrow: DataFrame | None = None
) -> DataFrame:
    """One row per check: position, expectation, passed, unexpected_pct, evaluated_count.

    All checks on single rows and means share one aggregation of the table. Each uniqueness
    check adds one shuffle of its own column. ``narrow`` may give the same rows with fewer
    columns, from before a join, for these.
    """
    narrow = df if narrow is None else narrow
    evaluated = F.count(F.lit(1))
    one_pass, parts = [], []
    for position, check in enumerate(checks, start=1):
        if check.kind == "unique":
            per_value = narrow.groupBy(F.col(check.column).alias("value")).agg(evaluated.alias("n"))
            is_value = F.col("value").isNotNull()
            counts = per_value.agg(
                F.coalesce(F.sum(F.when(is_value & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("bad"),
                F.coalesce(F.sum(F.when(is_value, F.col("n"))), F.lit(0)).alias("filled"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
            )
            row = _result(position, check, F.col("bad"), F.col("filled"), F.col("all"))
            parts.append(counts.select(row.alias("r")))
        elif check.kind == "mean_between":
            ok = F.coalesce(F.avg(check.column).between(*check.values), F.lit(False))
            one_pass.append(_result(position, check, F.lit(0), F.lit(1), evaluated, ok))
        else:
            one_pass.append(_result(position, check, *_row_check(check), evaluated))
    if one_pass:
        parts.insert(0, df.agg(F.array(*one_pass).alias("rs")).select(F.explode("rs").alias("r")))
    return reduce(DataFrame.unionByName, parts).select("r.*")


def run_suite(
    df: DataFrame,
    as_of: dt.datetime | str,
    checks: Sequence[Check] = EVENT_CHECKS,
    sample: int | None = None,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """One-row report: run_time, row_count, passed, total and the list of checks.

    The whole table is checked; ``sample`` restricts the report to the newest rows instead.
    """
    if sample is not None:
        df, narrow = newest(df, sample), None
    results = check_rows(df, checks, narrow)
    entries = F.sort_array(F.collect_list(F.struct(
        "position", "expectation", "passed", "unexpected_pct", "evaluated_count")))
    return results.agg(
        F.lit(str(as_of)).alias("run_time"),
        F.max("evaluated_count").alias("row_count"),
        F.count_if("passed").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.transform(entries, lambda e: e.dropFields("position")).alias("checks"),
    )


def label_guard(df: DataFrame, label: str = "churned", minimum: int = 10) -> DataFrame:
    """Are there enough positive labels to train on? Labels are never made up."""
    positives = F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        positives.alias("positives"),
        (positives >= minimum).alias("sufficient"),
    )
