"""Rounding and ratios with the semantics of SQL ``numeric``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal value, and return a double.

    Going through a decimal drops binary noise first: 1.005 gives 1.01, not 1.0.
    """
    return F.round(_col(value).cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double; null when the whole is zero."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    return half_up(ratio(part, whole) * 100, digits)


def to_number(value: Column | str) -> Column:
    """Numeric value of a column; what cannot be read as a number becomes null."""
    return _col(value).try_cast("double")
