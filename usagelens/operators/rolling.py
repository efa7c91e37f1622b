"""Rolling features over a daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rolling(
    daily: DataFrame,
    inputs: dict[str, str],
    n: int = 7,
    order: str = "event_date",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``{short}_ma{n}`` and ``{short}_std{n}`` for every ``{column: short}`` in ``inputs``.

    Mean and sample deviation over the last ``n`` rows; null until ``n`` values are there.
    Missing days are not filled in. Apply this to aggregated rows only: without ``keys`` the
    whole series, one row per day, is one window.
    """
    frame = W.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), W.currentRow)
    columns = {}
    for column, short in inputs.items():
        full = F.count(column).over(frame) == n
        columns[f"{short}_ma{n}"] = F.when(full, F.avg(column).over(frame))
        columns[f"{short}_std{n}"] = F.when(full, F.stddev_samp(column).over(frame))
    return daily.withColumns(columns)
