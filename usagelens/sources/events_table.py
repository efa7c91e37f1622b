"""The Parquet event table: idempotent inserts and retention.

The table is partitioned by ``event_date`` and has one writer at a time. Uniqueness of
``event_id`` is kept by the inserts below, through the index of :mod:`usagelens.sources.keyed_table`.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import dates
from usagelens.operators.keyed import first_per_key
from usagelens.schema import RAW_SCHEMA
from usagelens.session import delete, list_names, materialize, path_exists, scratch
from usagelens.sources.keyed_table import KeyedTable

TABLE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("event_date", T.DateType())])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("timestamp"))


def new_rows(
    batch: DataFrame,
    existing: DataFrame,
    order: Sequence[str] = ("timestamp",),
    key: str = "event_id",
) -> DataFrame:
    """Rows of ``batch`` to insert: the first one per key, unless the key exists already.

    For any two tables. The event table itself is asked through its index, see :func:`insert_new`.
    Only the key column of ``existing`` is read. The plan is the same for all sizes: adaptive execution
    sends a small batch to the table's partitions and shuffles both sides of a large one.
    """
    rows = first_per_key(batch, key, order)
    return rows.join(_stored(rows, existing, key), key, "left_anti")


def _stored(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Keys of ``rows`` that exist: no more than the rows, so that a join with them is small."""
    return existing.select(key).join(rows.select(key), key, "left_semi").distinct()


def event_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, TABLE_SCHEMA, "event_id", "event_date", ("timestamp", "user_id"),
                      lookups=("event_id", "user_id"))


#: Values of one pushed-down list; longer ones would only be pushed as a range.
PUSHED = 10


def _among(column: str, values: Sequence[str]) -> Column:
    """Whether a column has one of ``values``, as lists that reach the Bloom filters."""
    parts = [F.col(column).isin(list(values[i:i + PUSHED])) for i in range(0, len(values), PUSHED)]
    return functools.reduce(operator.or_, parts, F.lit(False))


def events_of_users(
    spark: SparkSession, path: str, users: Sequence[str], start: dt.datetime | str | None = None,
    end: dt.datetime | str | None = None,
) -> DataFrame:
    """The stored events of some users in ``[start, end)``.

    Days come from the folders, times from the files' statistics, and row groups without one of the
    users are skipped by their Bloom filters. ``users`` is part of the plan, so for a list from a caller;
    many users are better joined.
    """
    rows = read_events(spark, path).where(_among("user_id", [str(u) for u in users]))
    if start is not None:
        rows = rows.where((F.col("timestamp") >= dates.instant(start))
                          & (F.col("event_date") >= dates.instant(start).cast("date")))
    if end is not None:
        rows = rows.where((F.col("timestamp") < dates.instant(end))
                          & (F.col("event_date") <= dates.instant(end).cast("date")))
    return rows


def event_by_id(spark: SparkSession, path: str, event_id: str) -> DataFrame:
    """The stored event of an id, if there is one, found by the Bloom filters."""
    return read_events(spark, path).where(F.col("event_id") == event_id)


def insert_new(
    batch: DataFrame,
    path: str,
    order: Sequence[str] = ("timestamp",),
    prune_by_date: bool = False,
) -> int:
    """Append the unseen rows of ``batch`` to the table; gives the number of rows offered.

    Inserting the same batch again changes nothing, so a failed attempt can be repeated. Which ids are
    stored is asked of the table's index, in the buckets of the batch's ids only.
    ``prune_by_date`` looks for existing keys in the table, on the batch's own days. That is right
    when the id fixes the day, as the ids of time slots do, and wrong otherwise. Within a day the
    rows of a file are sorted by time and user, so that file statistics can skip.
    """
    spark = batch.sparkSession
    span = with_event_date(batch).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
    ).first()
    if span["n"] == 0:
        return 0

    def on_its_days(keys: DataFrame) -> DataFrame:
        days = F.col("event_date").between(F.lit(span["first"]), F.lit(span["last"]))
        return _stored(keys, read_events(spark, path).filter(days), "event_id")

    pruned = prune_by_date and path_exists(spark, path)
    rows = with_event_date(first_per_key(batch, "event_id", order))
    with scratch(spark):
        event_table(spark, path).append(rows, on_its_days if pruned else None)
    return span["n"]


def compact(spark: SparkSession, path: str, days: Sequence[dt.date | str]) -> None:
    """Write the files of these days anew, few and sorted by time and user; the rows stay as they are.

    The rows are first copied to the shared folder, so that a failure leaves the table readable.
    """
    chosen = read_events(spark, path).filter(F.col("event_date").isin([dates.day(d) for d in days]))
    with scratch(spark):
        copy = materialize(chosen, "compact")
        event_table(spark, path).writer(copy).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(path)


def _cutoff(as_of: dt.datetime | dt.date | str, keep_days: int):
    return dates.instant(as_of) - F.expr(f"interval {int(keep_days)} days")


def retain_recent(
    df: DataFrame, as_of: dt.datetime | dt.date | str, keep_days: int, ts: str = "timestamp"
) -> DataFrame:
    """Rows not older than ``keep_days`` days; a row exactly that old stays."""
    cutoff = _cutoff(as_of, keep_days)
    kept = F.col(ts) >= cutoff
    if "event_date" in df.columns:
        kept = kept & (F.col("event_date") >= cutoff.cast("date"))
    return df.filter(kept)


def cull_report(
    df: DataFrame, as_of: dt.datetime | dt.date | str, keep_days: int, ts: str = "timestamp"
) -> DataFrame:
    """One row: how many rows retention would delete and keep."""
    old = F.col(ts) < _cutoff(as_of, keep_days)
    return df.agg(F.count_if(old).alias("culled"), F.count_if(~old).alias("kept"))


def cull_table(
    spark: SparkSession, path: str, as_of: dt.datetime | str, keep_days: int
) -> int:
    """Delete rows older than ``keep_days`` days from the table; gives their number.

    Whole days are dropped as folders. Only the day the cutoff falls into is written again.
    """
    as_of = dt.datetime.fromisoformat(str(as_of))
    cutoff = as_of - dt.timedelta(days=keep_days)
    table = read_events(spark, path)
    border = table.filter(F.col("event_date") == F.lit(cutoff.date()))
    culled = table.filter(F.col("event_date") <= F.lit(cutoff.date())).agg(
        F.count_if(F.col("timestamp") < dates.instant(cutoff)).alias("n")).first()["n"]
    if culled == 0:
        return 0

    kept = retain_recent(border, as_of, keep_days)
    rewrite = not kept.isEmpty()
    if rewrite:
        event_table(spark, path).writer(kept).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(path)

    for name in list_names(spark, path):
        if not name.startswith("event_date="):
            continue
        day = name.removeprefix("event_date=")
        if day < cutoff.date().isoformat() or (day == cutoff.date().isoformat() and not rewrite):
            delete(spark, os.path.join(path, name))
    return culled
