import datetime as dt

import pytest
from pyspark.sql import functions as F

from usagelens.schema import RAW_SCHEMA, conform, stage
from usagelens.sources.events_table import (
    compact, cull_report, cull_table, event_by_id, events_of_users, insert_new, new_rows, read_events, retain_recent,
)


@pytest.fixture
def raw(spark, make_events):
    def make(rows):
        df = make_events(rows).withColumns({
            "model_variant": F.lit("m"), "sdk_version": F.lit("1.2.3"), "session_id": F.lit("s"),
            "rate_limited": F.lit(False),
        })
        return conform(df)

    return make


def stored(spark, path):
    return {r["event_id"]: r for r in read_events(spark, path).collect()}


def test_conform_fills_defaults_and_types(spark, raw):
    row = raw([{}])
    assert [f.dataType for f in row.schema.fields] == [f.dataType for f in RAW_SCHEMA.fields]
    got = row.first()
    assert got["will_churn"] is False and got["churn_day"] is None and got["ingested_at"] is not None


def test_conform_strict_rejects_a_missing_value(spark, make_events):
    df = make_events([{}]).drop("region")
    assert conform(df).first()["region"] is None
    with pytest.raises(Exception, match="must not be null"):
        conform(df, strict=True).collect()


def test_stage_derives_columns(spark, raw):
    got = stage(raw([{"timestamp": "2024-01-01 23:59:59", "status_code": 400}])).first()
    assert got["event_date"] == dt.date(2024, 1, 1)
    assert got["is_error"] is True and got["total_tokens"] == 150 and got["latency_ms"] == 10.0


def test_insert_is_idempotent_and_the_first_writer_wins(spark, raw, tmp_path):
    path = str(tmp_path / "events")
    batch = raw([
        {"event_id": "a", "timestamp": "2024-01-02 10:00:00", "user_id": "late"},
        {"event_id": "a", "timestamp": "2024-01-01 10:00:00", "user_id": "early"},
        {"event_id": "b", "timestamp": "2024-01-01 11:00:00"},
    ])
    assert insert_new(batch, path) == 3
    insert_new(batch, path)
    again = raw([
        {"event_id": "a", "timestamp": "2023-12-01 00:00:00", "user_id": "other"},
        {"event_id": "c", "timestamp": "2024-01-03 00:00:00"},
    ])
    insert_new(again, path)
    rows = read_events(spark, path)
    assert rows.count() == 3
    got = stored(spark, path)
    assert set(got) == {"a", "b", "c"} and got["a"]["user_id"] == "early"
    assert got["a"]["event_date"] == dt.date(2024, 1, 1)


def test_insert_of_nothing(spark, raw, tmp_path):
    path = str(tmp_path / "events")
    assert insert_new(raw([{}]).limit(0), path) == 0


def test_batches_one_after_another_and_compaction(spark, raw, tmp_path):
    path = str(tmp_path / "events")
    insert_new(raw([{"event_id": "a"}, {"event_id": "b"}]), path)
    insert_new(raw([{"event_id": "b"}, {"event_id": "c"}]), path)
    before = stored(spark, path)
    files = len(list((tmp_path / "events").rglob("*.parquet")))
    compact(spark, path, ["2024-01-01"])
    spark.catalog.clearCache()
    assert stored(spark, path) == before and set(before) == {"a", "b", "c"}
    assert len(list((tmp_path / "events").rglob("*.parquet"))) < files


def test_prune_by_date_looks_at_the_days_of_the_batch(spark, raw, tmp_path):
    path = str(tmp_path / "events")
    insert_new(raw([{"event_id": "a", "timestamp": "2024-01-01 00:00:00"}]), path)
    same = raw([{"event_id": "a", "timestamp": "2024-01-01 05:00:00"}])
    insert_new(same, path, prune_by_date=True)
    assert read_events(spark, path).count() == 1


def test_a_key_with_most_copies(spark):
    batch = spark.range(30_000).selectExpr(
        "if(id % 3 > 0, 'hot', concat('k', id)) AS event_id", "30000 - id AS timestamp", "id AS v")
    got = new_rows(batch, batch.limit(0))
    assert got.count() == 10_001
    assert got.filter("event_id = 'hot'").first()["v"] == 29_999


def test_retention_keeps_the_cutoff_itself(spark, raw):
    df = raw([
        {"event_id": "old", "timestamp": "2024-01-20 11:59:59"},
        {"event_id": "edge", "timestamp": "2024-01-20 12:00:00"},
        {"event_id": "new", "timestamp": "2024-01-25 00:00:00"},
    ])
    kept = retain_recent(df, "2024-01-30 12:00:00", 10)
    assert {r["event_id"] for r in kept.collect()} == {"edge", "new"}
    assert cull_report(df, "2024-01-30 12:00:00", 10).first().asDict() == {"culled": 1, "kept": 2}


@pytest.mark.parametrize("edge_kept", [True, False])
def test_cull_table_drops_days_and_rewrites_the_border(spark, raw, tmp_path, edge_kept):
    path = str(tmp_path / "events")
    rows = [
        {"event_id": "older", "timestamp": "2024-01-05 00:00:00"},
        {"event_id": "old", "timestamp": "2024-01-20 11:59:59"},
        {"event_id": "new", "timestamp": "2024-01-25 00:00:00"},
    ]
    if edge_kept:
        rows.append({"event_id": "edge", "timestamp": "2024-01-20 12:00:00"})
    insert_new(raw(rows), path)
    assert cull_table(spark, path, "2024-01-30 12:00:00", 10) == 2
    spark.catalog.clearCache()
    assert set(stored(spark, path)) == ({"new", "edge"} if edge_kept else {"new"})
    assert cull_table(spark, path, "2024-01-30 12:00:00", 10) == 0


def rows_read(df):
    """Rows that the scan gave out, after row groups were skipped."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_row_groups_without_a_user_are_skipped(spark, raw, tmp_path):
    path = str(tmp_path / "events")
    # Every file has users around all others, so least and greatest say nothing.
    for n in range(4):
        insert_new(raw([{"event_id": f"e{n}-{i}", "user_id": u, "timestamp": f"2024-01-0{i % 3 + 1} 0{n}:00:00"}
                        for i, u in enumerate(["a", "z", f"u{n}"] * 4)]), path)
    spark.catalog.clearCache()
    assert read_events(spark, path).count() == 48
    found = events_of_users(spark, path, ["u2", *[f"x{i}" for i in range(20)]])
    assert {r["user_id"] for r in found.collect()} == {"u2"} and found.count() == 4
    assert rows_read(found) <= 12
    assert rows_read(events_of_users(spark, path, ["m"])) == 0 and rows_read(event_by_id(spark, path, "e1-55")) == 0
    assert [r["event_id"] for r in event_by_id(spark, path, "e1-5").collect()] == ["e1-5"]
    some = events_of_users(spark, path, ["a", "u1"], "2024-01-02 01:00:00", "2024-01-03 02:00:00")
    assert sorted(r["event_id"] for r in some.collect()) == sorted(
        r["event_id"] for r in read_events(spark, path).collect()
        if r["user_id"] in ("a", "u1") and dt.datetime(2024, 1, 2, 1) <= r["timestamp"].replace(tzinfo=None)
        < dt.datetime(2024, 1, 3, 2))
    assert events_of_users(spark, path, []).count() == 0
    compact(spark, path, ["2024-01-01", "2024-01-02", "2024-01-03"])
    assert rows_read(events_of_users(spark, path, ["m"])) == 0
