"""The plans Spark makes of the operators."""

import pytest
from pyspark.sql import functions as F

from usagelens.operators import filters
from usagelens.operators.keyed import latest_per_key
from usagelens.plans import reports
from usagelens.schema import conform, stage
from usagelens.session import materialize, path_exists, scratch, scratch_path, shared_root
from usagelens.sources import testtables
from usagelens.sources.events_table import insert_new, new_rows, read_events, retain_recent


SF_DIR = "/root/testdata/sf0.001"


def plan(df, formatted=False):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    execution = df._jdf.queryExecution()
    return execution.explainString(mode) if formatted else execution.executedPlan().toString()


@pytest.fixture
def table(spark, make_events, tmp_path):
    rows = make_events([
        {"event_id": str(i), "timestamp": f"2024-01-{i:02d} 00:00:00"} for i in range(1, 11)
    ]).withColumns({c: F.lit("x") for c in ("model_variant", "sdk_version", "session_id")}
                   ).withColumn("rate_limited", F.lit(False))
    path = str(tmp_path / "events")
    insert_new(conform(rows), path)
    return read_events(spark, path)


def test_shared_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root and scratch_path(spark, "x").startswith(root)
    assert materialize(spark.range(3), "numbers").count() == 3


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    out = str(tmp_path / "out")
    outer = materialize(spark.range(2), "stays")
    with scratch(spark):
        first = materialize(spark.range(3), "goes")
        with scratch(spark):
            materialize(first, "goes-too").write.parquet(out)
        paths = [f for df in (first,) for f in df.inputFiles()]
        assert first.count() == 3
    assert not any(path_exists(spark, p) for p in paths)
    assert spark.read.parquet(out).count() == 3 and outer.count() == 2


def test_date_filters_reach_the_partitions(table):
    for df in (
        filters.last_days(stage(table), "2024-01-10", 3),
        filters.time_range(stage(table), "2024-01-02", "2024-01-03 12:00:00"),
        retain_recent(stage(table), "2024-01-10", 3),
    ):
        scan = next(line for line in plan(df, formatted=True).splitlines() if "PartitionFilters" in line)
        assert "event_date" in scan


def test_reports_read_only_their_columns(table):
    text = plan(reports.dau(stage(table)), formatted=True)
    assert "ReadSchema: struct<user_id:string>" in text


def test_newest_day_prunes_partitions(table):
    # The newest day is looked up by the plan itself, so nothing is read while it is built.
    text = plan(filters.latest_day(stage(table)), formatted=True)
    assert "PartitionFilters: [isnotnull(event_date" in text and "Subquery" in text
    text = plan(reports.current_metrics(stage(table)), formatted=True)
    scans = [line for line in text.splitlines() if "PartitionFilters" in line and "event_date" in line]
    assert scans and all("Subquery" in line for line in scans)


def test_newest_rows_come_from_the_newest_days(table):
    rows = stage(table)
    for n in (1, 3, 10, 50):
        got = filters.newest_of_days(rows, n)
        assert got.collect() == filters.newest(rows, n).collect()
    text = plan(filters.newest_of_days(rows, 2), formatted=True)
    assert any("event_date" in line and "Subquery" in line for line in text.splitlines() if "PartitionFilters" in line)
    assert filters.newest_of_days(rows.limit(0), 2).count() == 0


def test_top_k_is_not_a_full_sort(table):
    for df in (filters.newest(stage(table), 3), reports.errors_top(stage(table))):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_last_row_per_key_is_an_aggregate(table):
    text = plan(latest_per_key(table.select("user_id", "timestamp"), "user_id", ["timestamp"]))
    assert "Window" not in text and text.count("Aggregate") == 2


def test_inserts_leave_the_join_to_the_planner(table):
    text = plan(new_rows(table.limit(2), table), formatted=True)
    assert "LeftSemi" in text and "LeftAnti" in text
    assert "hint" not in text.lower()


def test_users_are_not_joined_where_they_are_not_used(spark):
    text = plan(testtables.usage_days(spark, SF_DIR).groupBy("user_id").count())
    assert "c_custkey" not in text and "Join" not in text


def test_a_busy_user_is_split_in_the_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    session = spark.newSession()
    for key, value in settings.items():
        session.conf.set(key, value)
    events = testtables.events(session, SF_DIR)
    copies = events.crossJoin(session.range(300).select(F.col("id").alias("copy"))).withColumn(
        "user_id", F.when(F.col("copy") > 10, F.lit(7).cast("long")).otherwise(F.col("user_id"))
    ).repartition(16)
    execution = testtables.with_users(copies, SF_DIR)._jdf.queryExecution()
    assert execution.toRdd().count() == events.count() * 300
    assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()


def test_customers_are_not_sent_through_the_driver(spark):
    # However small their file looks, it is the nations that are broadcast.
    text = testtables.users(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    (join,) = [line for line in text.splitlines() if "BroadcastHashJoin [c_nationkey" in line]
    assert "BuildRight" in join
