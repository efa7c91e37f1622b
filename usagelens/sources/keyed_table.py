"""Parquet tables that have each key once, with an index of their keys.

The index says which keys are stored without a look at the table. It is a set of runs in the folder
``_keys`` of the table, which readers of the table skip. An insert adds one run with its own keys. A run
is partitioned by a hash of the key, into as many buckets as its size asks for, and sorted by key in
each, so a lookup reads the buckets of the looked-up keys only. Runs of about one size are merged when
there are several of them: their number, and how often a key is written again, grow with the logarithm
of the table.

A table has one writer at a time, which may fail at any moment. The keys of an insert are written before
its rows, under a name that lookups skip, and get their name as a run after the rows. The next insert
that finds such keys looks for them in the table, on their days only, and keeps those it finds.
"""

from __future__ import annotations

import math
import os
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.session import delete, list_names, materialize, rename

FOLDER = "_keys"
RUN, PENDING, MERGING = "run", "pending", "merging"
#: Rows of a bucket, about, and how many runs of one size are merged.
BUCKET_ROWS, FAN = 250_000, 8
#: Buckets are folders, so a very large run has larger ones instead of more than 2^14.
MOST_BITS = 14


@dataclass(frozen=True)
class Run:
    """A part of the index; its name has the kind, the number of keys, and the number of buckets."""

    name: str

    @property
    def kind(self) -> str:
        return self.name.split("-")[0]

    @property
    def rows(self) -> int:
        return int(self.name.split("-")[1])

    @property
    def buckets(self) -> int:
        return int(self.name.split("-")[2])

    @property
    def size_class(self) -> int:
        return int(math.log(max(self.rows, 1), FAN))

    def called(self, kind: str) -> str:
        return "-".join([kind, *self.name.split("-")[1:]])


@dataclass(frozen=True)
class KeyedTable:
    """``schema`` has all columns of the table, ``day`` is its partition column, if it has one, and
    ``sort`` the order of rows in a file. Columns of ``lookups`` get Bloom filters, by which readers skip
    the row groups without a value."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    day: str | None = None
    sort: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()
    bucket_rows: int = BUCKET_ROWS

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def append(self, rows: DataFrame, known: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Insert ``rows``, which have each key once, unless the key is stored; gives those inserted.

        Inserting the same rows again changes nothing. ``known``, from keys to those that are stored,
        takes the place of the index, for a caller who can tell them more cheaply.
        """
        fresh = self.unseen(rows, known)
        pending = self._write(fresh.select(*self._key_columns()), fresh.count(), PENDING)
        if pending:
            self._add_rows(fresh)
            self._promote(pending)
            self._merge()
        return fresh

    def unseen(self, rows: DataFrame, known: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Those of ``rows`` whose key is not stored, written to the shared folder."""
        self.prepare()
        rows = materialize(rows.select(*self.schema.names), "insert")
        stored = (known or self.known)(rows)
        return materialize(rows.join(stored, self.key, "left_anti").select(*self.schema.names), "insert-new")

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (the key column) that are stored, each once.

        Only the buckets of the keys are read; their numbers, at most as many as there are buckets,
        come to the driver. Keys of days that the table no longer has do not count.
        """
        found = keys.select(self.key).limit(0)
        groups = defaultdict(list)
        for run in self._runs(RUN):
            groups[run.buckets].append(run)
        for buckets, runs in groups.items():
            stored = self.in_buckets(runs, keys)
            if self.day and (days := self._days()):
                stored = stored.where(F.col("day") >= F.lit(min(days)).cast("date"))
            found = found.union(stored.join(keys.select(self.key), self.key, "left_semi").select(self.key))
        return found.distinct()

    def in_buckets(self, runs: Sequence[Run], keys: DataFrame) -> DataFrame:
        """The rows of ``runs``, all of one number of buckets, in the buckets of ``keys``."""
        bucket = self._bucket(runs[0].buckets)
        wanted = [r[0] for r in keys.select(bucket.alias("bucket")).distinct().collect()]
        return self._read_runs(runs).where(F.col("bucket").isin(wanted))

    def prepare(self) -> None:
        """Finish what an insert that failed has left, and index a table that has no index yet."""
        left = self._runs(PENDING)
        if not self._runs(RUN):
            if not any(not n.startswith("_") for n in list_names(self.spark, self.path)):
                stored = None
            else:
                stored = materialize(self.read().select(*self._key_columns()).distinct(), "index-build")
            self._index(stored)
        else:
            for run in left:
                self._index(self._stored_of(run))
        for run in [*left, *self._runs(MERGING)]:
            delete(self.spark, self._at(run))

    def _stored_of(self, run: Run) -> DataFrame:
        keys, rows = self._read_runs([run]).drop("bucket"), self.read().select(*self._key_columns())
        if self.day:
            span = keys.agg(F.min("day"), F.max("day")).first()
            rows = rows.where(F.col("day").between(F.lit(span[0]), F.lit(span[1])))
        return materialize(rows.join(keys.select(self.key), self.key, "left_semi"), "index-recover")

    def _index(self, keys: DataFrame | None) -> None:
        if keys is not None and (run := self._write(keys, keys.count(), MERGING)):
            self._promote(run)

    def _merge(self) -> None:
        classes = defaultdict(list)
        for run in self._runs(RUN):
            classes[run.size_class].append(run)
        for runs in classes.values():
            if len(runs) < FAN:
                continue
            merged = self._write(self._read_runs(runs).drop("bucket"), sum(r.rows for r in runs), MERGING)
            self._promote(merged)
            for run in runs:
                delete(self.spark, self._at(run))
            return self._merge()

    def writer(self, rows: DataFrame) -> DataFrameWriter:
        """A writer of ``rows`` in the table's layout."""
        if self.day:
            # Rebalancing splits a day with a third of all rows and merges small ones.
            rows = rows.hint("rebalance", F.col(self.day)).sortWithinPartitions(self.day, *self.sort)
        writer = rows.write.partitionBy(self.day) if self.day else rows.write
        return writer.options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in self.lookups})

    def _add_rows(self, rows: DataFrame) -> None:
        self.writer(rows).mode("append").parquet(self.path)

    def _write(self, keys: DataFrame, rows: int, kind: str) -> Run | None:
        if rows == 0:
            return None
        buckets = 1 << min(MOST_BITS, (rows // self.bucket_rows).bit_length())
        run = Run(f"{kind}-{rows}-{buckets}-{uuid.uuid4().hex}")
        dealt = keys.withColumn("bucket", self._bucket(buckets)).hint("rebalance", F.col("bucket"))
        dealt.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(self._at(run))
        return run

    def _promote(self, run: Run) -> None:
        rename(self.spark, self._at(run), self._at(Run(run.called(RUN))))

    def _read_runs(self, runs: Sequence[Run]) -> DataFrame:
        columns = T.StructType([self.schema[self.key], *([T.StructField("day", T.DateType())] if self.day else [])])
        partitions = T.StructType.fromDDL("part string, bucket int")
        reader = self.spark.read.schema(T.StructType([*columns, *partitions]))
        folder = os.path.join(self.path, FOLDER)
        return reader.option("basePath", folder).parquet(*map(self._at, runs)).drop("part")

    def _key_columns(self) -> list[Column]:
        return [F.col(self.key), *([F.col(self.day).alias("day")] if self.day else [])]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _at(self, run: Run) -> str:
        return os.path.join(self.path, FOLDER, f"part={run.name}")

    def _runs(self, kind: str) -> list[Run]:
        names = list_names(self.spark, os.path.join(self.path, FOLDER))
        runs = [Run(n.removeprefix("part=")) for n in names if n.startswith("part=")]
        return sorted((r for r in runs if r.kind == kind), key=lambda r: r.name)

    def _days(self) -> list[str]:
        names = [n.split("=", 1) for n in list_names(self.spark, self.path) if n.startswith(f"{self.day}=")]
        return [value for _, value in names if value[:1].isdigit()]
