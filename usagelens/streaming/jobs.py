"""Streaming ingest, deduplication and live metrics."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions.numeric import ratio
from usagelens.operators.keyed import first_per_key
from usagelens.schema import RAW_SCHEMA, conform
from usagelens.session import delete, list_names, path_exists, rename, scratch
from usagelens.sources.events_table import insert_new
from usagelens.sources.keyed_table import KeyedTable


def ingest_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    order: Sequence[str] = ("timestamp",),
    strict: bool = True,
    prune_by_date: bool = False,
) -> StreamingQuery:
    """Drain a stream of events into the event table and stop.

    A batch that fails is delivered again; the insert ignores ids already stored, so every
    event ends up in the table once, however often it was sent.
    """
    # Arrival columns decide between duplicates but are not stored.
    arrival = [c for c in order if c not in RAW_SCHEMA.names]

    def insert(batch: DataFrame, batch_id: int) -> None:
        insert_new(conform(batch, strict, keep=arrival), sink, order, prune_by_date)

    return _drain(stream, insert, checkpoint)


def dedup_stream(
    stream: DataFrame, sink: str, checkpoint: str, key: str = "event_id",
    order: Sequence[str] = ("timestamp",),
) -> StreamingQuery:
    """Drain a stream of any schema into a table that has each id once, and stop.

    The table's index is the state, so an event counts however late it comes and whatever lies between
    two copies; nothing is dropped for being behind a watermark. A batch reads the index in the buckets
    of its own ids, and never the table.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            KeyedTable(batch.sparkSession, sink, batch.schema, key).append(first_per_key(batch, key, order))

    return _drain(stream, insert, checkpoint)


def window_metrics(events: DataFrame, every: str, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Traffic, errors, latency, tokens and users per tumbling window."""
    return events.groupBy(F.window(ts, every), *keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("error_count"),
        ratio(F.count_if("is_error"), F.count(F.lit(1))).alias("error_rate"),
        F.avg("latency_ms").alias("avg_latency"),
        F.sum("total_tokens").alias("tokens"),
        F.countDistinct("user_id").alias("users"),
    ).select(
        F.to_date("window.start").alias("window_date"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, "requests", "error_count", "error_rate", "avg_latency", "tokens", "users",
    )


#: Columns of a part that are added up.
PART_SUMS = ("requests", "error_count", "latency_total", "latency_count", "tokens")


def window_parts(events: DataFrame, every: str, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Per tumbling window what can be merged into :func:`window_metrics`: counts, sums, and a sketch
    of the users."""
    latency = F.col("latency_ms").cast("double")
    return events.groupBy(F.window(ts, every), *keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("error_count"),
        F.sum(latency).alias("latency_total"),
        F.count(latency).alias("latency_count"),
        F.sum("total_tokens").alias("tokens"),
        F.hll_sketch_agg("user_id").alias("user_sketch"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
             *PART_SUMS, "user_sketch")


def merged_parts(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per window of any number of :func:`window_parts`."""
    sketch = F.hll_union_agg("user_sketch").alias("user_sketch")
    return parts.groupBy("window_start", "window_end", *keys).agg(
        *[F.sum(c).alias(c) for c in PART_SUMS], sketch)


def window_users(events: DataFrame, every: str, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Each window's users, once."""
    start = F.window(ts, every).getField("start").alias("window_start")
    return events.select(start, *keys, F.col("user_id").alias("user")).distinct()


#: Parts of a generation that are merged into one.
MERGED_PARTS = 16


def live_metrics(
    stream: DataFrame, events: str, sink: str, checkpoint: str, every: str = "1 hour",
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Keep :func:`window_metrics` of a stream of staged events up to date, and stop when drained;
    :func:`read_live_metrics` gives them.

    A batch's new events are added to the table ``events``, by day, and their counts, sums and users
    to ``sink``, as a part of its own. So a batch costs what its own rows cost, late events change the
    windows they belong to, and none is lost. The new events are first written aside under the batch's
    name: a batch that is delivered again counts the same rows and writes the same part.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            add_part(batch, f"{run}-{batch_id}")

    def add_part(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        _merge_generation(spark, sink, keys, keep=name)
        batch = batch.withColumn("event_date", F.to_date("timestamp"))
        table = KeyedTable(spark, events, batch.schema, "event_id", "event_date", ("timestamp",))
        aside = os.path.join(sink, "new", name)
        if begun := path_exists(spark, os.path.join(aside, "_SUCCESS")):
            fresh = spark.read.schema(batch.schema).parquet(aside)
        else:
            fresh = table.unseen(first_per_key(batch, "event_id", ("timestamp",)))
            fresh.write.mode("overwrite").parquet(aside)
        # Only a batch that was begun before may be stored in part.
        table.append(fresh, None if begun else lambda rows: rows.select("event_id").limit(0))
        at = _generations(spark, sink)[-1]
        window_users(fresh, every, keys).write.mode("overwrite").parquet(os.path.join(at, "users", name))
        window_parts(fresh, every, keys).write.mode("overwrite").parquet(os.path.join(at, "parts", name))

    return _drain(stream, merge, checkpoint)


def _generations(spark: SparkSession, sink: str) -> list[str]:
    """Folders of parts, the one that holds last; earlier ones are left over from a merge."""
    names = sorted(n for n in list_names(spark, sink) if n.startswith("generation-"))
    return [os.path.join(sink, n) for n in names or ["generation-00000000"]]


def _read_parts(spark: SparkSession, at: str, kind: str, skip: str = "") -> DataFrame | None:
    names = [n for n in list_names(spark, os.path.join(at, kind)) if n != skip]
    paths = [os.path.join(at, kind, n) for n in names if path_exists(spark, os.path.join(at, kind, n, "_SUCCESS"))]
    return spark.read.parquet(*paths) if paths else None


def _merge_generation(spark: SparkSession, sink: str, keys: Sequence[str], keep: str) -> None:
    """Merge the parts of earlier batches, which are committed, into one, when there are many.

    The next generation is written aside and named when it is complete. The part ``keep``, of a batch
    that is delivered again, is left out: that batch writes it anew.
    """
    *old, at = _generations(spark, sink)
    for path in old:
        delete(spark, path)
    if len(list_names(spark, os.path.join(at, "parts"))) < MERGED_PARTS:
        return
    number = int(at.rsplit("-", 1)[1]) + 1
    aside = os.path.join(sink, "merging")
    for kind, merged in (("parts", lambda df: merged_parts(df, keys)), ("users", lambda df: df.distinct())):
        merged(_read_parts(spark, at, kind, skip=keep)).write.mode("overwrite").parquet(
            os.path.join(aside, kind, f"to-{number}"))
    rename(spark, aside, os.path.join(sink, f"generation-{number:08d}"))
    delete(spark, at)
    for name in list_names(spark, os.path.join(sink, "new")):
        if name != keep:
            delete(spark, os.path.join(sink, "new", name))


def read_live_metrics(spark: SparkSession, sink: str, keys: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """The metrics that :func:`live_metrics` keeps; ``approx`` estimates the users from the sketches.

    The exact number reads the users of each window, of which there are far fewer than events.
    """
    at = _generations(spark, sink)[-1]
    merged = merged_parts(_read_parts(spark, at, "parts"), keys)
    window = ["window_start", *keys]
    if approx:
        merged = merged.withColumn("users", F.hll_sketch_estimate("user_sketch"))
    else:
        counted = _read_parts(spark, at, "users").distinct().groupBy(*window).agg(F.count("user").alias("users"))
        same = [F.col(f"m.{c}").eqNullSafe(F.col(f"u.{c}")) for c in window]
        merged = merged.alias("m").join(counted.alias("u"), same).select("m.*", "u.users")
    return merged.select(
        F.to_date("window_start").alias("window_date"), "window_start", "window_end", *keys, "requests",
        "error_count", ratio("error_count", "requests").alias("error_rate"),
        ratio("latency_total", "latency_count").alias("avg_latency"), "tokens", "users",
    )


def _drain(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
