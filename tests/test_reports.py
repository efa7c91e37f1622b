import datetime as dt

import pytest
from pyspark.sql import functions as F

from usagelens.functions.numeric import half_up
from usagelens.operators import cohorts, filters
from usagelens.operators.keyed import first_per_key, latest_per_key
from usagelens.operators.measures import user_days
from usagelens.operators.rolling import rolling
from usagelens.plans import marts, reports, training
from usagelens.sources import files

D = dt.date


@pytest.fixture
def sample(make_events):
    return make_events([
        {"timestamp": "2024-01-01 00:00:00", "user_id": "a", "latency_ms": 10.0},
        {"timestamp": "2024-01-02 00:00:00", "user_id": "a", "latency_ms": 20.0, "status_code": 429,
         "error_type": "RateLimitError"},
        {"timestamp": "2024-01-02 01:00:00", "user_id": "b", "latency_ms": 30.0, "user_tier": "pro"},
        {"timestamp": "2024-01-02 02:00:00", "user_id": "a", "latency_ms": 41.0, "endpoint": "/v1/classify"},
    ])


def test_current_metrics_of_the_newest_day(sample):
    got = reports.current_metrics(sample).first().asDict()
    assert got == {"dau": 2, "requests": 3, "error_rate": 0.3333, "avg_latency": 30.3,
                   "p95_latency": 39.9, "tokens": 450}


def test_metrics_of_an_empty_table(sample):
    empty = sample.limit(0)
    got = reports.current_metrics(empty).first()
    assert got["dau"] == 0 and got["requests"] == 0 and got["error_rate"] is None
    assert reports.endpoint_metrics(empty).count() == 0
    assert reports.time_series(empty, "2024-01-31").count() == 0
    assert reports.errors_top(empty).count() == 0


def test_events_with_a_count_of_their_own_are_events(sample):
    counted = sample.withColumn("request_count", F.lit(100))
    assert reports.dau(counted).collect() == reports.dau(sample).collect()
    assert reports.user_tiers(counted).collect() == reports.user_tiers(sample).collect()


def test_narrative(sample):
    text = reports.narrative(sample).first()["narrative"]
    assert text == (
        "Platform Health Summary:\n- DAU: 2\n- Requests: 3\n- Error Rate: 33.33%\n"
        "- Avg Latency: 30.3ms\n- P95 Latency: 39.9ms\n"
        "Above its limit: error rate.")
    assert reports.narrative(sample, 40.0).first()["narrative"].endswith("\nNo figure is above its limit.")
    assert reports.narrative(sample, 5.0, 30.0).first()["narrative"].endswith("error rate and P95 latency.")


def test_time_series_includes_the_first_day(sample):
    assert reports.time_series(sample, "2024-01-31", 30).count() == 2
    assert reports.time_series(sample, "2024-01-31", 29).count() == 1


def test_reports_agree_between_events_and_rollup(sample):
    rollup = user_days(sample)
    for report in (reports.dau, reports.token_usage, reports.user_tiers, reports.daily_tier_panel,
                   reports.daily_latency_error, lambda d: reports.time_series(d, "2024-01-31")):
        assert report(sample).collect() == report(rollup).collect()


def test_approximate_metrics(sample):
    exact = {r["endpoint"]: r["requests"] for r in reports.endpoint_metrics(sample).collect()}
    rough = {r["endpoint"]: r["requests"] for r in reports.endpoint_metrics(sample, approx=True).collect()}
    assert exact == rough == {"/v1/chat": 3, "/v1/classify": 1}
    assert reports.current_metrics(sample, approx=True).first()["dau"] == 2


def test_partial_days(sample):
    daily = reports.dau(sample)
    got = {r["event_date"].day: (r["is_partial"], r["is_bridge"])
           for r in filters.mark_partial(daily, "2024-01-02").collect()}
    assert got == {1: (False, True), 2: (True, False)}
    none = filters.mark_partial(daily, "2023-12-31").collect()
    assert all(r["is_partial"] and not r["is_bridge"] for r in none)


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(half_up("x", 2)).collect()] == [1.01, 2.68, -0.13]


def test_rolling_needs_full_windows_and_skips_no_days(spark):
    days = [D(2024, 1, d) for d in (1, 2, 3, 5, 6, 7, 9, 20)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "event_date date, x double")
    got = rolling(df, {"x": "x"}, 7).orderBy("event_date").collect()
    assert [r["x_ma7"] for r in got] == [None] * 6 + [3.0, 4.0]
    assert got[-1]["x_std7"] == pytest.approx(2.160246899)
    keyed = rolling(df.withColumn("k", F.dayofmonth("event_date") % 2), {"x": "x"}, 3, keys=["k"])
    assert keyed.filter("x_ma3 IS NOT NULL").count() == 8 - 4


def test_cohorts_equal_brute_force(spark):
    rows = [(i * 7 % 13, D(2023, 11, 1) + dt.timedelta(days=i * 17 % 400)) for i in range(150)]
    df = spark.createDataFrame(rows, "user_id int, event_date date")
    want = {}
    for user in {u for u, _ in rows}:
        months = {d.year * 12 + d.month - 1 for u, d in rows if u == user}
        for m in months:
            first = min(months)
            key = (D(first // 12, first % 12 + 1, 1), m - first)
            want[key] = want.get(key, 0) + 1
    long = cohorts.cohort_retention(df)
    got = {(r["cohort_month"], r["months_since_cohort"]): r["active_users"] for r in long.collect()}
    assert got == want and max(age for _, age in want) > 12
    report = reports.cohort_report(df).collect()
    assert {(r["cohort_month"], r["months_since_cohort"]): r["active_users"] for r in report} == {
        k: n for k, n in want.items() if k[1] <= 12}
    wide = cohorts.cohort_matrix(long)
    assert wide.columns == ["cohort_month"] + [f"age_{i}" for i in range(13)]
    cells = {(r["cohort_month"], i): r[f"age_{i}"] for r in wide.collect() for i in range(13)
             if r[f"age_{i}"] is not None}
    assert cells == {k: n for k, n in want.items() if k[1] <= 12}


def test_a_cell_given_twice_is_an_error(spark):
    long = spark.createDataFrame([(D(2024, 1, 1), 0, 5), (D(2024, 1, 1), 0, 6)],
                                 "cohort_month date, months_since_cohort int, active_users bigint")
    with pytest.raises(Exception, match="duplicate cohort"):
        cohorts.cohort_matrix(long).collect()


def test_return_visits(spark):
    rows = [("a", 1), ("a", 1), ("a", 8), ("a", 16), ("b", 2), ("c", 23), ("a", 30)]
    df = spark.createDataFrame([(u, D(2024, 1, d)) for u, d in rows], "user_id string, event_date date")
    got = {(r["user_id"], r["event_date"].day): r["retained"] for r in cohorts.retained_within(df).collect()}
    # Day 30 is the last one, so visits after day 23 have no known outcome.
    assert got == {("a", 1): 1, ("a", 8): 0, ("a", 16): 0, ("b", 2): 0, ("c", 23): 0}


def test_two_tiers_on_one_day_are_no_return(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), "free"), ("a", D(2024, 1, 1), "pro"), ("b", D(2024, 1, 20), "free")],
        "user_id string, event_date date, user_tier string")
    got = cohorts.retained_within(df, keep=["user_tier"]).collect()
    assert [(r["user_tier"], r["retained"]) for r in sorted(got)] == [("free", 0), ("pro", 0)]


def test_first_and_latest_per_key_break_ties(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 0, "z"), ("j", 5, None)],
                               "key string, t int, v string")
    assert sorted(map(tuple, latest_per_key(df, "key", ["t"]).collect())) == [("j", 5, None), ("k", 1, "b")]
    assert sorted(map(tuple, first_per_key(df, "key", ["t"]).collect())) == [("j", 5, None), ("k", 0, "z")]


def test_marts_and_their_incremental_refresh(spark, sample, tmp_path):
    out = str(tmp_path / "marts")
    paths = marts.build_marts(spark, sample, out)
    assert set(paths) == {*marts.DAILY_FROM_EVENTS, *marts.FROM_PARTS, *marts.FROM_ROLLUP}
    assert spark.table(marts.STAGING_VIEW).count() == 4
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert sorted(tables["dau"].collect()) == sorted(reports.dau(sample).collect())
    assert tables["cohort_retention"].count() == 1
    checks = marts.check_marts(tables)
    assert set(r["mart"] for r in checks.collect()) == set(paths)
    assert checks.count() == 21 and checks.filter("NOT passed").count() == 0
    with pytest.raises(ValueError, match="no checks"):
        marts.check_marts({"unheard_of": sample})

    # Events of the first day are gone from the source; its stored days stay.
    later = sample.filter("event_date > '2024-01-01'").unionByName(
        sample.filter("user_id = 'b'").withColumn("user_id", F.lit("z")))
    marts.build_marts(spark, later, out, since="2024-01-02")
    got = {r["event_date"].day: r["dau"] for r in spark.read.parquet(paths["dau"]).collect()}
    assert got == {1: 1, 2: 3}
    # A full refresh leaves nothing of days that are gone.
    marts.build_marts(spark, later, out)
    assert [r["dau"] for r in spark.read.parquet(paths["dau"]).collect()] == [3]


def test_sinks(spark, sample, tmp_path):
    rows = sample.select("event_id", "error_type").orderBy("event_id").coalesce(1)
    files.write_csv(rows, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["event_id", "error_type"]
    files.write_json(rows, str(tmp_path / "json"))
    assert '"error_type":null' in spark.read.text(str(tmp_path / "json")).first()["value"]
    files.write_text(rows.select("event_id"), str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).count() == 4


def test_sql_with_parameters(spark, sample):
    sample.createOrReplaceTempView("sample_events")
    got = files.read_sql(spark, "SELECT count(*) AS n FROM sample_events WHERE user_id = :user", user="a")
    assert got.first()["n"] == 3


def test_training_run(spark, make_events, tmp_path):
    rows = []
    for u in range(40):
        churn_day = 3 if u % 2 else None
        for d in range(1, 20 if u % 2 == 0 else 4):
            rows.append({"timestamp": f"2024-01-{d:02d} 10:{u:02d}:00", "user_id": f"u{u:02d}",
                         "user_tier": ["free", "pro", "enterprise"][u % 3], "latency_ms": 10.0 + u + d,
                         "region": "us" if u % 4 < 2 else "eu", "churn_day": churn_day,
                         "status_code": 500 if (u + d) % 5 == 0 else 200})
    paths = training.train_all(
        make_events(rows), "2024-01-31", str(tmp_path / "out"), "2024-01-08", "enterprise", "us",
        inactive_days=7, rounds=3)
    assert spark.read.json(paths["label_guard"]).first()["sufficient"] is True
    assert spark.read.csv(paths["anomalies"], header=True).count() == 13
    assert spark.read.json(paths["importances"]).count() == 9
    assert spark.read.json(paths["metrics"]).count() == 2
    assert spark.read.csv(paths["survival_curves"], header=True).columns[:2] == ["user_tier", "timeline"]
    assert spark.read.text(paths["causal_report"]).count() == 2
    assert spark.read.text(paths["narrative"]).first()["value"].startswith("Platform Health Summary")
