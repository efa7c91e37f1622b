"""The event table: its schema, its domains, and the step from raw rows to the staged view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("user_tier", T.StringType(), False),
    T.StructField("endpoint", T.StringType(), False),
    T.StructField("model_variant", T.StringType(), False),
    T.StructField("input_tokens", T.IntegerType(), False),
    T.StructField("output_tokens", T.IntegerType(), False),
    T.StructField("latency_ms", T.DecimalType(10, 2), False),
    T.StructField("status_code", T.IntegerType(), False),
    T.StructField("error_type", T.StringType(), True),
    T.StructField("sdk_version", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("rate_limited", T.BooleanType(), False),
    T.StructField("will_churn", T.BooleanType(), True),
    T.StructField("churn_day", T.IntegerType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

# What a producer sends: everything but the time stamp set at the sink.
WIRE_SCHEMA = T.StructType([f for f in RAW_SCHEMA.fields if f.name != "ingested_at"])

# The domains of the event columns.
USER_TIERS = ["free", "pro", "enterprise"]
ENDPOINTS = ["/v1/completions", "/v1/chat", "/v1/embeddings", "/v1/classify"]
ALLOWED_STATUS_CODES = [200, 400, 401, 403, 429, 500, 503, 504]

_OPTIONAL_DEFAULTS = {
    "will_churn": lambda: F.lit(False),
    "ingested_at": F.current_timestamp,
}


def _conformed(df: DataFrame, field: T.StructField, strict: bool) -> Column:
    present = field.name in df.columns
    value = F.col(field.name).cast(field.dataType) if present else F.lit(None).cast(field.dataType)
    if field.name in _OPTIONAL_DEFAULTS:
        value = F.coalesce(value, _OPTIONAL_DEFAULTS[field.name]())
    elif strict and not field.nullable:
        missing = F.raise_error(F.lit(f"{field.name} must not be null")).cast(field.dataType)
        value = F.coalesce(value, missing)
    return value.alias(field.name)


def conform(df: DataFrame, strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to ``RAW_SCHEMA`` and fill its defaults; columns named in ``keep`` stay as well.

    A missing ``will_churn`` becomes false, a missing ``churn_day`` stays null and
    ``ingested_at`` defaults to now. ``strict`` makes a null in a required column fail the
    job, as a NOT NULL constraint would.
    """
    return df.select(*[_conformed(df, field, strict) for field in RAW_SCHEMA.fields], *keep)


def stage(df: DataFrame) -> DataFrame:
    """Add the derived columns every report uses.

    ``event_date`` is kept when the table already carries it (as its partition column), so
    that a date filter reaches the file listing.
    """
    derived = {
        "latency_ms": F.col("latency_ms").cast("double"),
        "is_error": F.col("status_code") >= 400,
        "total_tokens": F.col("input_tokens").cast("long") + F.col("output_tokens").cast("long"),
    }
    if "event_date" not in df.columns:
        derived["event_date"] = F.to_date("timestamp")
    return df.withColumns(derived)
