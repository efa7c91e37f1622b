"""Stored counts: what a report reads of the events, and marts that grow by days."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import cohorts
from usagelens.operators.histograms import latency_parts, part_percentile, part_totals
from usagelens.plans import marts, reports
from tests.test_plans import plan


@pytest.fixture
def stored(spark, tmp_path):
    """Staged events of ten days by folder: the last three have slow requests, all others fast ones."""
    rows = spark.range(4_000).selectExpr(
        "concat('e', id) AS event_id", "date_add(date'2024-01-01', cast(id % 10 AS int)) AS event_date",
        "concat('u', id * 7919 % 61) AS user_id", "if(id % 9 = 0, 'pro', 'free') AS user_tier", "'eu' AS region",
        "if(id % 3 = 0, '/v1/chat', '/v1/classify') AS endpoint", "10 AS input_tokens", "5 AS output_tokens",
        "15L AS total_tokens", "200 AS status_code", "id % 50 = 0 AS is_error", "cast(null AS int) AS churn_day",
        "if(id % 10 < 7, 10 + id % 100 / 10, 700 + id % 977 / 7) AS latency_ms",
    ).withColumn("timestamp", F.col("event_date").cast("timestamp"))
    path = str(tmp_path / "events")
    rows.write.partitionBy("event_date").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def rows_of(df):
    # Sums of doubles depend on the order of the rows in their last digits.
    exact = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(str(tuple(map(exact, row))) for row in df.collect())


def plain_p95(df):
    pdf = df.select("endpoint", "latency_ms").toPandas()
    return pdf.groupby("endpoint")["latency_ms"].quantile(0.95).to_dict()


def test_the_percentile_reads_only_days_and_values_near_it(stored):
    parts = latency_parts(stored, ["event_date", "endpoint"])
    p95 = part_percentile(parts, stored, ["endpoint"], 0.95, "p")
    got = {r["endpoint"]: r["p"] for r in p95.collect()}
    assert got == pytest.approx(plain_p95(stored))
    text = plan(p95, formatted=True)
    scans = [line for line in text.splitlines() if "PartitionFilters" in line and "event_date" in line]
    assert any("2024-01-08" in s and "2024-01-01" not in s for s in scans)
    assert "GreaterThanOrEqual(latency_ms" in text and "LessThanOrEqual(latency_ms" in text


def test_reports_from_parts_are_those_from_events(stored):
    parts = latency_parts(stored, ["event_date", "endpoint"])
    assert rows_of(reports.endpoint_metrics(stored, parts=parts)) == rows_of(reports.endpoint_metrics(stored))
    assert rows_of(reports.current_metrics(stored, parts=parts)) == rows_of(reports.current_metrics(stored))
    assert rows_of(reports.narrative(stored, parts=parts)) == rows_of(reports.narrative(stored))


def test_events_are_read_twice(stored):
    """Once for the counts, which are stored, and once near the percentile."""
    report = reports.endpoint_metrics(stored)
    report._jdf.queryExecution().toRdd().count()
    final = plan(report).split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len([s for s in scans if "DataFilters: [isnotnull(latency_ms" in s]) == 1
    assert all("user" in s or "bucket" in s for s in scans if "isnotnull(latency_ms" not in s)


def test_a_bucket_of_one_value_needs_no_events(stored):
    same = stored.withColumn("latency_ms", F.lit(12.5))
    parts = latency_parts(same, ["event_date", "endpoint"])
    p95 = part_percentile(parts, stored.where("false"), ["endpoint"], 0.95, "p")
    assert {r["p"] for r in p95.collect()} == {12.5} and p95.count() == 2


@pytest.mark.parametrize("values", [
    [1.0, 2.0, float("nan")], [None, 3.0, 5.0], [None], [float("inf"), 1.0, float("-inf"), 0.0],
    [float("nan")] * 3, [1.0] * 99 + [1.0000001]])
def test_odd_latencies(spark, values):
    df = spark.createDataFrame([("k", "u", False, 1, v) for v in values],
                               "endpoint string, user_id string, is_error boolean, total_tokens int, latency_ms double")
    parts = latency_parts(df, ["endpoint"])
    got = [r["p"] for r in part_percentile(parts, df, ["endpoint"], 0.5, "p").collect()]
    known = sorted((v for v in values if v is not None), key=lambda v: (np.isnan(v), v))
    if not known:
        assert got == []
    else:
        low, high = known[(len(known) - 1) // 2], known[len(known) // 2]
        want = low if str(low) == str(high) else low + (high - low) * 0.5
        assert got[0] == pytest.approx(want, nan_ok=True)
    totals = part_totals(parts, ["endpoint"]).first()
    assert totals["requests"] == len(values) and totals["users"] == 1 and totals["latency_rows"] == len(known)


def test_a_refresh_reads_no_old_events(spark, stored, tmp_path):
    full = marts.build_marts(spark, stored, str(tmp_path / "full"))
    paths = marts.build_marts(spark, stored.where("event_date <= '2024-01-09'"), str(tmp_path / "grown"))
    # The percentiles lie in the last three days, so the days before can go.
    for day in range(1, 8):
        shutil.rmtree(tmp_path / "events" / f"event_date=2024-01-{day:02d}")
    left = spark.read.schema(stored.schema).parquet(str(tmp_path / "events"))
    marts.build_marts(spark, left, str(tmp_path / "grown"), since="2024-01-09")
    for name, path in paths.items():
        rows = spark.read.parquet(path)
        assert rows_of(rows) == rows_of(spark.read.parquet(full[name]).select(rows.columns)), name


def test_months_of_users_over_many_years(spark):
    rows = spark.range(3_000).selectExpr(
        "id * 31 % 97 AS user_id", "add_months(date'1969-11-05', cast(id * 7919 % 401 AS int)) AS event_date",
    ).unionByName(spark.createDataFrame([(1, None), (None, None)], "user_id long, event_date date"))
    full = cohorts.cohort_retention(rows.where("event_date is not null"))
    cut = F.col("event_date") < "1990-01-01"
    parts = cohorts.user_months(rows.where(cut)).unionByName(cohorts.user_months(rows.where(~cut)))
    grown = cohorts.cohorts_of_months(cohorts.merged_months(parts))
    assert grown.columns == full.columns and rows_of(grown) == rows_of(full)


def test_a_mart_of_months_that_is_not_whole_is_built_anew(spark, stored, tmp_path):
    paths = marts.build_marts(spark, stored, str(tmp_path / "m"))
    before = rows_of(spark.read.parquet(paths["cohort_retention"]))
    (tmp_path / "m" / marts.MONTHS / "_SUCCESS").unlink()
    marts.build_marts(spark, stored, str(tmp_path / "m"), since="2024-01-10")
    assert rows_of(spark.read.parquet(paths["cohort_retention"])) == before
