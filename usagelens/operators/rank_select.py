"""Exact order statistics without sorting a group in one task.

A group's rows are first counted into a bounded number of value buckets (combined map-side),
which tells in which bucket a rank lies. Only the rows of that bucket are looked at again, and
counted into fine buckets of it, and only the rows of the fine bucket with the rank are counted by
value. So no task ever holds more than a bucket table, or the distinct values of a very narrow bucket,
however large or hot the group is. It is one lazy plan for all sizes; how the located ranks are joined
is left to adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.functions.numeric import half_up

# Buckets per doubling of the value: about 0.3 % wide, and for narrowing about 1e-6.
COARSE, FINE = 256, 1 << 20

# Doublings between the smallest magnitude told apart and one, and up to the largest double.
LOW_EXPONENT, HIGH_EXPONENT = 64, 1024


def magnitude_bucket(value: Column, per_octave: int) -> Column:
    """Order-preserving bucket of a double, of a width relative to the value.

    Infinities have the buckets at the ends, and NaN, which sorts last, one beyond.
    """
    last = (LOW_EXPONENT + HIGH_EXPONENT + 1) * per_octave + 2
    magnitude = F.greatest(F.abs(value), F.lit(2.0 ** -LOW_EXPONENT))
    finite = F.when(magnitude < float("inf"), magnitude).otherwise(F.lit(1.0))
    steps = F.floor(F.log2(finite) * per_octave) + LOW_EXPONENT * per_octave + 1
    sign = F.when(value > 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    return (F.when(F.isnan(value), F.lit(last + 1))
            .when(value == 0, F.lit(0))
            .when(magnitude == float("inf"), sign * last)
            .otherwise(sign * steps)).cast("long")


def running_counts(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add ``_before`` (rows in smaller buckets) and ``_group_rows`` to per-bucket ``_rows``."""
    w = W.partitionBy(*keys)
    up_to_here = w.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.withColumns({
        "_before": F.sum("_rows").over(up_to_here) - F.col("_rows"),
        "_group_rows": F.sum("_rows").over(w),
    })


def _same(keys: Sequence[str]) -> Column:
    # Null keys form a group too, hence the null-safe comparison.
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return match


def _holds(rank: str) -> Column:
    """Does this bucket (or value) hold the rank?"""
    return (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_rows"))


RANKS = ["_low", "_high", "_weight"]


def _narrow(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the values that share a fine bucket with a wanted rank."""
    keys = [*keys, "_bucket"]
    values = values.withColumn("_fine", magnitude_bucket(F.col("_value"), FINE))
    counted = values.groupBy(*keys, "_fine", "_start", *RANKS).agg(F.sum("_rows").alias("_rows"))
    found = running_counts(counted, keys, "_fine").withColumn(
        "_before", F.col("_before") + F.col("_start"))
    found = found.filter(_holds("_low") | _holds("_high")).select(
        *keys, "_fine", F.col("_before").alias("_narrow_start"))
    kept = values.alias("l").join(found.alias("r"), _same([*keys, "_fine"]))
    return kept.select("l.*", "r._narrow_start").drop("_start").withColumnRenamed(
        "_narrow_start", "_start")


def located_ranks(counted: DataFrame, keys: Sequence[str], p: float) -> DataFrame:
    """The buckets of ``counted`` (keys, _bucket, _rows) that hold the ranks of a percentile."""
    rank = (F.col("_group_rows") - 1) * F.lit(float(p))
    located = running_counts(counted, keys, "_bucket").withColumns({
        "_low": F.floor(rank), "_high": F.ceil(rank), "_weight": rank - F.floor(rank),
    })
    return located.filter(_holds("_low") | _holds("_high")).withColumnRenamed("_before", "_start").drop("_group_rows")


def percentile_near(
    rows: DataFrame, located: DataFrame, keys: Sequence[str], name: str, known: DataFrame | None = None
) -> DataFrame:
    """The percentile from those of ``rows`` (keys, _value, _bucket) that lie in ``located`` buckets.

    ``known`` are located buckets of a single ``_value``, for which no rows are needed.
    """
    keys = list(keys)
    columns = [*keys, "_bucket", "_start", *RANKS]
    wanted = located if known is None else located.filter("_least < _most")
    near = rows.alias("l").join(wanted.alias("r"), _same([*keys, "_bucket"])).select(
        "l.*", *[f"r.{c}" for c in ("_start", *RANKS)])
    values = near.groupBy(*keys, "_bucket", "_value", "_start", *RANKS).agg(
        F.count(F.lit(1)).alias("_rows"))
    if known is not None:
        values = values.unionByName(known.select(*columns, "_value", "_rows"))
    values = _narrow(values, keys)
    placed = running_counts(values, [*keys, "_bucket", "_fine"], "_value").withColumn(
        "_before", F.col("_before") + F.col("_start"))
    low = F.max(F.when(_holds("_low"), F.col("_value")))
    high = F.max(F.when(_holds("_high"), F.col("_value")))
    # The same value on both sides, also an infinite one, is the percentile as it is.
    between = F.when(low == high, low).otherwise(low + (high - low) * F.max("_weight"))
    return placed.groupBy(*keys).agg(between.alias(name))


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, name: str
) -> DataFrame:
    """Linearly interpolated percentile (``percentile_cont``) of ``value`` per ``keys``.

    Nulls are ignored; NaN counts as the greatest value. The result is lazy.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_value")).filter(F.col("_value").isNotNull())
    rows = rows.withColumn("_bucket", magnitude_bucket(F.col("_value"), COARSE))
    counted = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    return percentile_near(rows, located_ranks(counted, keys, p), keys, name)


def percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    name: str,
    approx: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Percentile per group, exact by default; ``approx`` takes one pass and no extra job."""
    if approx:
        out = df.groupBy(*keys).agg(
            F.percentile_approx(F.col(value).cast("double"), float(p), 10_000).alias(name)
        )
    else:
        out = exact_percentile(df, keys, value, p, name)
    return out if digits is None else out.withColumn(name, half_up(name, digits))
