"""Tables with a key index: what a lookup reads, and inserts that fail half-way."""

import os

import pytest
from pyspark.sql import functions as F

from usagelens.sources import keyed_table
from usagelens.sources.keyed_table import MERGING, PENDING, RUN, KeyedTable
from tests.test_plans import plan


@pytest.fixture
def table(spark, tmp_path):
    def make(**options):
        schema = spark.createDataFrame([], "id string, v long, d date").schema
        return KeyedTable(spark, str(tmp_path / "t"), schema, "id", "d", **options)

    return make


def rows(spark, low, high, v=0, step=1):
    return spark.range(low, high, step).selectExpr(
        "concat('k', id) AS id", f"{v}L AS v", "date_add(date'2024-01-01', cast(id % 5 AS int)) AS d")


def stored(table):
    table.spark.catalog.clearCache()
    found = [r["id"] for r in table.read().collect()]
    assert len(found) == len(set(found))
    return set(found)


def ids(*spans):
    return {f"k{i}" for low, high in spans for i in range(low, high)}


def test_a_lookup_reads_the_buckets_of_its_keys(spark, table):
    t = table(bucket_rows=100)
    t.append(rows(spark, 0, 10_000))
    (run,) = t._runs(RUN)
    assert run.rows == 10_000 and run.buckets == 128
    keys = rows(spark, 9_998, 10_003)
    wanted = {r[0] for r in keys.select(t._bucket(128)).collect()}
    scan = t.in_buckets([run], keys)
    assert "PartitionFilters: [bucket" in plan(scan).replace("isnotnull(bucket", "")
    assert {r[0] for r in scan.select("bucket").distinct().collect()} == wanted
    files = {os.path.dirname(f) for f in scan.inputFiles()}
    assert len(wanted) <= 5 and 0 < scan.count() < 1_000 and all("bucket=" in f for f in files)
    assert {r["id"] for r in t.known(keys).collect()} == {"k9998", "k9999"}


def test_inserts_read_no_rows_of_the_table(spark, table, monkeypatch):
    t = table()
    t.append(rows(spark, 0, 50))
    reads = []
    monkeypatch.setattr(KeyedTable, "read", lambda self: reads.append(1))
    fresh = t.append(rows(spark, 40, 60))
    assert {r["id"] for r in fresh.collect()} == ids((50, 60)) and not reads


def test_runs_are_merged_and_stay_right(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_table, "FAN", 3)
    t = table(bucket_rows=20)
    for n in range(10):
        t.append(rows(spark, 10 * n, 10 * n + 15, v=n))
    assert stored(t) == ids((0, 105)) and len(t._runs(RUN)) < 6
    assert sum(r.rows for r in t._runs(RUN)) == 105 and not t._runs(MERGING) and not t._runs(PENDING)
    assert {r["v"] for r in t.read().where("id = 'k12'").collect()} == {0}


@pytest.mark.parametrize("step", ["_add_rows", "_promote"])
@pytest.mark.parametrize("first", [True, False])
def test_a_crash_between_the_two_writes(spark, table, monkeypatch, step, first):
    t = table()
    if not first:
        t.append(rows(spark, 0, 5))
    whole = getattr(KeyedTable, step)

    def fails(self, what):
        if step == "_add_rows":
            # Some of the days are written when the job dies.
            whole(self, what.where("d < '2024-01-03'"))
        raise OSError("executor lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(KeyedTable, step, fails)
        t.append(rows(spark, 3, 30))
    again = table()
    for _ in range(2):
        again.append(rows(spark, 3, 30))
        assert stored(t) == ids((3 if first else 0, 30)) and not again._runs(PENDING)
    again.append(rows(spark, 25, 35))
    assert stored(t) == ids((3 if first else 0, 35))


def test_a_table_without_an_index_gets_one(spark, table):
    t = table()
    rows(spark, 0, 20).write.partitionBy("d").parquet(t.path)
    t.append(rows(spark, 10, 30))
    assert stored(t) == ids((0, 30)) and sum(r.rows for r in t._runs(RUN)) == 30


def test_keys_of_days_that_are_gone_do_not_count(spark, table):
    t = table()
    t.append(rows(spark, 0, 20))
    keyed_table.delete(spark, os.path.join(t.path, "d=2024-01-01"))
    assert {r["id"] for r in t.append(rows(spark, 0, 22)).collect()} == {"k0", "k5", "k10", "k15", "k20", "k21"}
    assert stored(t) == ids((0, 22))


def test_null_and_repeated_keys(spark, table):
    t = table()
    some = spark.createDataFrame([("a", 1, None), (None, 2, None)], "id string, v long, d date")
    t.append(some)
    t.append(some.where("id = 'a'"))
    assert sorted(r["v"] for r in t.read().collect()) == [1, 2]


def test_nothing_to_insert(spark, table):
    t = table()
    assert t.append(rows(spark, 0, 0)).count() == 0
    t.append(rows(spark, 0, 3))
    assert t.append(rows(spark, 0, 0)).count() == 0 and stored(t) == ids((0, 3))


def test_without_days(spark, tmp_path):
    schema = spark.createDataFrame([], "n long, v string").schema
    t = KeyedTable(spark, str(tmp_path / "plain"), schema, "n")
    for low in (0, 5):
        t.append(spark.range(low, low + 10).select(F.col("id").alias("n"), F.lit("x").alias("v")))
    assert sorted(r["n"] for r in t.read().collect()) == list(range(15))
