"""First or last row per key, by aggregation.

A window would sort all rows of a key in one task; a min or max of a struct is combined before
the shuffle, so even a key with a third of all rows sends one row per task. With strings in the struct
Spark aggregates over sorted partitions, which spill. Fetching the rows by a join on a hash of the
order instead would sort nothing there but shuffle every row with all of its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return chosen.select(*[
        F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns
    ])


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Earliest row per key by ``order``; the other columns break ties."""
    return _pick(df, keys, order, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order``; the other columns break ties."""
    return _pick(df, keys, order, F.max)
