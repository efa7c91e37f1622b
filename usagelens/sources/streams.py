"""Event streams from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from usagelens.functions.wire import decode_events
from usagelens.schema import RAW_SCHEMA
from usagelens.sources import kafka


def read_events_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType = RAW_SCHEMA,
    bad: str = "fail",
) -> DataFrame:
    """Stream of events: ``kafka``, ``json`` (one message per line), ``parquet`` or ``orc``."""
    options = dict(options or {})
    if fmt == "kafka":
        return kafka.read_events(spark, options, bad=bad)
    if fmt == "json":
        return decode_events(spark.readStream.options(**options).text(path), bad=bad)
    if fmt in ("parquet", "orc"):
        return spark.readStream.schema(schema).options(**options).format(fmt).load(path)
    raise ValueError(f"unsupported stream format {fmt!r}")
