import json

import pytest
from pyspark.sql import functions as F

from usagelens.functions.wire import decode_events
from usagelens.schema import conform
from usagelens.sources.events_table import new_rows, read_events
from usagelens.sources.streams import read_events_stream
from usagelens.streaming import jobs
from tests.test_wire import EVENT


def message(event_id, minute=0, **extra):
    return json.dumps({**EVENT, "event_id": event_id,
                       "timestamp": f"2024-03-01T12:{minute:02d}:00+00:00", **extra})


def publish(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(messages))


def drain(spark, tmp_path, **options):
    stream = read_events_stream(spark, "json", options, str(tmp_path / "in"))
    jobs.ingest_stream(stream, str(tmp_path / "table"), str(tmp_path / "ckpt")).awaitTermination()
    return read_events(spark, str(tmp_path / "table"))


def test_ingest_across_restarts_and_repeated_messages(spark, tmp_path):
    publish(tmp_path / "in", "1.json", [message("a"), message("b"), message("a", 5, user_id="late")])
    assert drain(spark, tmp_path).count() == 2
    publish(tmp_path / "in", "2.json", [message("b"), message("c", 7)])
    publish(tmp_path / "in", "3.json", [message("c", 7), message("d", 9)])
    table = drain(spark, tmp_path, maxFilesPerTrigger="1")
    rows = {r["event_id"]: r["user_id"] for r in table.collect()}
    assert table.count() == 4 and rows == {k: "u1" for k in "abcd"}
    # A lost checkpoint replays everything, without effect.
    stream = read_events_stream(spark, "json", {}, str(tmp_path / "in"))
    jobs.ingest_stream(stream, str(tmp_path / "table"), str(tmp_path / "ckpt2")).awaitTermination()
    assert read_events(spark, str(tmp_path / "table")).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    messages = [message(f"e{i % 23}", i % 60, latency_ms=float(i)) for i in range(80)]
    publish(tmp_path / "in", "1.json", messages)
    columns = ["event_id", "timestamp", "latency_ms"]
    streamed = drain(spark, tmp_path).select(columns)
    batch = conform(decode_events(spark.createDataFrame([(m,) for m in messages], "value string")))
    batch = batch.drop("ingested_at")
    assert sorted(streamed.collect()) == sorted(new_rows(batch, batch.limit(0)).select(columns).collect())


def test_arrival_order_decides_between_copies(spark, tmp_path):
    # As with Kafka, the position in the log says which copy came first.
    publish(tmp_path / "in", "1.json", [message("a", 30, user_id="first"), message("a", 10, user_id="second")])
    stream = read_events_stream(spark, "json", {}, str(tmp_path / "in")).withColumn(
        "offset", F.when(F.col("user_id") == "first", 1).otherwise(2))
    jobs.ingest_stream(stream, str(tmp_path / "table"), str(tmp_path / "ckpt"),
                       order=["offset"]).awaitTermination()
    assert [r["user_id"] for r in read_events(spark, str(tmp_path / "table")).collect()] == ["first"]


def test_a_bad_message_stops_the_stream(spark, tmp_path):
    publish(tmp_path / "in", "1.json", [message("a"), "{broken"])
    with pytest.raises(Exception):
        drain(spark, tmp_path)


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_events_stream(spark, "avro", path="x")


def staged(stream):
    return stream.withColumns({
        "is_error": F.col("status_code") >= 400,
        "total_tokens": F.col("input_tokens") + F.col("output_tokens"),
    })


# Five files out of order: most of what comes later is older, and some ids come again.
FILES = [
    [("a", 50), ("b", 51)], [("c", 1), ("d", 2), ("a", 50)], [("e", 59), ("f", 3)],
    [("g", 10), ("h", 11), ("i", 12), ("c", 1)], [("j", 0), ("k", 5), ("l", 20), ("m", 40), ("n", 41)],
]


def publish_out_of_order(tmp_path):
    for i, rows in enumerate(FILES):
        publish(tmp_path / "in", f"{i}.json", [message(e, m, user_id=f"u{m % 2}") for e, m in rows])


def test_live_metrics_count_late_events(spark, tmp_path):
    publish_out_of_order(tmp_path)
    out = {n: str(tmp_path / n) for n in ("events", "windows", "ckpt", "ckpt2")}
    for checkpoint in ("ckpt", "ckpt2"):  # the second replays everything, without effect
        stream = staged(read_events_stream(spark, "json", {"maxFilesPerTrigger": "1"}, str(tmp_path / "in")))
        jobs.live_metrics(stream, out["events"], out["windows"], out[checkpoint], every="10 minutes").awaitTermination()
        spark.catalog.clearCache()
        got = {r["window_start"].minute: (r["requests"], r["users"])
               for r in jobs.read_live_metrics(spark, out["windows"]).collect()}
        assert got == {0: (5, 2), 10: (3, 2), 20: (1, 1), 40: (2, 2), 50: (3, 2)}


def test_dedup_keeps_late_events(spark, tmp_path):
    publish_out_of_order(tmp_path)
    stream = read_events_stream(spark, "json", {"maxFilesPerTrigger": "1"}, str(tmp_path / "in"))
    jobs.dedup_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert sorted(r["event_id"] for r in got.collect()) == list("abcdefghijklmn")


def live(spark, tmp_path, checkpoint, **options):
    stream = staged(read_events_stream(spark, "json", {"maxFilesPerTrigger": "1"}, str(tmp_path / "in")))
    jobs.live_metrics(stream, str(tmp_path / "events"), str(tmp_path / "windows"), str(tmp_path / checkpoint),
                      every="10 minutes", **options).awaitTermination()
    spark.catalog.clearCache()


def windows(spark, tmp_path, **options):
    return {(r["window_start"].minute, r["user_id"] if "user_id" in r else None): (r["requests"], r["users"])
            for r in jobs.read_live_metrics(spark, str(tmp_path / "windows"), **options).collect()}


EXPECTED = {(0, None): (5, 2), (10, None): (3, 2), (20, None): (1, 1), (40, None): (2, 2), (50, None): (3, 2)}


@pytest.mark.parametrize("lost", ["window_users", "window_parts"])
def test_a_batch_that_fails_half_way_is_counted_once(spark, tmp_path, monkeypatch, lost):
    publish_out_of_order(tmp_path)
    whole, calls = getattr(jobs, lost), []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("executor lost")
        return whole(*args)

    monkeypatch.setattr(jobs, lost, fails_once)
    with pytest.raises(Exception, match="executor lost"):
        live(spark, tmp_path, "ckpt")
    live(spark, tmp_path, "ckpt")
    assert windows(spark, tmp_path) == windows(spark, tmp_path, approx=True) == EXPECTED


def test_parts_are_merged_between_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "MERGED_PARTS", 2)
    publish_out_of_order(tmp_path)
    live(spark, tmp_path, "ckpt")
    names = [p.name for p in (tmp_path / "windows").iterdir() if p.name.startswith("generation")]
    assert len(names) == 1 and names != ["generation-00000000"]
    assert len(list((tmp_path / "windows" / names[0] / "parts").iterdir())) <= 2
    assert windows(spark, tmp_path) == windows(spark, tmp_path, approx=True) == EXPECTED
    live(spark, tmp_path, "ckpt2")
    assert windows(spark, tmp_path) == EXPECTED


def test_keyed_windows(spark, tmp_path):
    publish_out_of_order(tmp_path)
    live(spark, tmp_path, "ckpt", keys=["user_id"])
    found = windows(spark, tmp_path, keys=["user_id"])
    assert found[0, "u0"] == (2, 1) and found[0, "u1"] == (3, 1) and sum(n for n, _ in found.values()) == 14


def test_a_batch_reads_only_its_own_windows(spark, tmp_path, monkeypatch):
    publish_out_of_order(tmp_path)
    read = []
    monkeypatch.setattr(jobs.KeyedTable, "read", lambda self: read.append(1))
    live(spark, tmp_path, "ckpt")
    assert not read and windows(spark, tmp_path) == EXPECTED
