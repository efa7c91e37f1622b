"""The JSON form of an event on the wire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.schema import WIRE_SCHEMA

# Fixed value: ISO-8601 with microseconds and a numeric offset.
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def encode_event(df: DataFrame) -> Column:
    """One flat JSON object per row; nulls are written out, as the decoder expects all keys."""
    names = [f.name for f in WIRE_SCHEMA.fields if f.name in df.columns]
    return F.to_json(
        F.struct(*names),
        {"timestampFormat": ISO_TIMESTAMP, "ignoreNullFields": "false"},
    )


# Keys without which a message is no event.
REQUIRED = ("event_id", "timestamp", "user_id")

CORRUPT = "_corrupt_record"


def _parsed(df: DataFrame, value: str) -> DataFrame:
    """``df`` with ``_event``, the parsed message, and ``_reject``, why it is none (null if it is).

    Timestamps are parsed by a cast, which takes any ISO-8601 fraction and offset. A value of the
    wrong type makes a message malformed, like broken JSON.
    """
    ddl = ", ".join(
        f"{f.name} {'string' if f.name == 'timestamp' else f.dataType.simpleString()}"
        for f in WIRE_SCHEMA.fields
    )
    text = F.col(value).cast("string")
    event = F.from_json(text, f"{ddl}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = df.withColumn("_event", event)
    reason = F.when(text.isNull() | (F.trim(text) == ""), "empty").when(
        F.col("_event").isNull() | F.col(f"_event.{CORRUPT}").isNotNull(), "malformed")
    for key in REQUIRED:
        reason = reason.when(F.col(f"_event.{key}").isNull(), f"no {key}")
    reason = reason.when(F.col("_event.timestamp").try_cast("timestamp").isNull(), "bad timestamp")
    return rows.withColumn("_reject", reason)


def decode_events(df: DataFrame, value: str = "value", bad: str = "fail") -> DataFrame:
    """Parse JSON messages; columns other than the message are kept.

    A message is valid if it is JSON with values of the right types, all required keys and a
    timestamp that can be read. ``bad`` says what an invalid one does: ``fail`` the job, become a
    row of ``null`` values, or ``drop``; :func:`rejected` gives the dropped ones.
    """
    if bad not in ("fail", "null", "drop"):
        raise ValueError(f"bad must be fail, null or drop, not {bad!r}")
    kept = [c for c in df.columns if c != value]
    rows = _parsed(df, value)
    valid = F.col("_reject").isNull()
    if bad == "fail":
        valid = valid | F.raise_error(F.concat(F.lit("invalid message: "), F.col("_reject"))).cast("boolean")
    if bad == "drop":
        rows = rows.filter(valid)
    return rows.select(*kept, *[
        F.when(valid, F.col(f"_event.{f.name}").try_cast(f.dataType)).alias(f.name)
        for f in WIRE_SCHEMA.fields
    ])


def rejected(df: DataFrame, value: str = "value") -> DataFrame:
    """The invalid messages of ``df`` with all their columns and the ``reason``."""
    return _parsed(df, value).filter(F.col("_reject").isNotNull()).select(
        *df.columns, F.col("_reject").alias("reason"))
