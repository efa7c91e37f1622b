from usagelens.operators import quality
from usagelens.operators.quality import check_rows, label_guard, run_suite


def by_name(df):
    return {r["expectation"]: (r["passed"], r["unexpected_pct"], r["evaluated_count"])
            for r in df.collect()}


def test_violations_with_nulls_and_duplicates(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("a", 5.0, 2), (None, None, 3), ("b", 9.0, 4)], "k string, v double, n int")
    got = by_name(check_rows(df, [
        quality.not_null("k"), quality.unique("k"), quality.in_set("k", ["a"]),
        quality.between("v", 1, 5), quality.mean_between("n", 2, 3), quality.mean_between("v", 0, 1),
        quality.unique("n"),
    ]))
    assert got == {
        "k not null": (False, 25.0, 4), "k unique": (False, 66.67, 4), "k in set": (False, 33.33, 4),
        "v in range": (False, 33.33, 4), "n mean in range": (True, 0.0, 4),
        "v mean in range": (False, 0.0, 4), "n unique": (True, 0.0, 4),
    }


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, v double")
    got = by_name(check_rows(df, [
        quality.not_null("k"), quality.unique("k"), quality.mean_between("v", 0, 1)]))
    assert got == {"k not null": (True, 0.0, 0), "k unique": (True, 0.0, 0),
                   "v mean in range": (False, 0.0, 0)}


def test_report_shape_and_sample(spark, make_events):
    events = make_events([
        {"event_id": "x", "timestamp": "2024-01-01 00:00:00", "user_tier": "gold"},
        {"event_id": "y", "timestamp": "2024-01-02 00:00:00"},
        {"event_id": "z", "timestamp": "2024-01-02 00:00:01"},
    ])
    report = run_suite(events, "2024-01-31").first()
    assert (report["run_time"], report["row_count"], report["passed"], report["total"]) == (
        "2024-01-31", 3, 7, 8)
    assert [c["expectation"] for c in report["checks"]] == [c.name for c in quality.EVENT_CHECKS]
    assert report["checks"][3].asDict() == {
        "expectation": "user_tier in set", "passed": False, "unexpected_pct": 33.33,
        "evaluated_count": 3}
    sampled = run_suite(events, "2024-01-31", sample=2).first()
    assert (sampled["row_count"], sampled["passed"]) == (2, 8)


def test_label_guard(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(0,)] * 5, "churned int")
    assert label_guard(df).first().asDict() == {"row_count": 14, "positives": 9, "sufficient": False}
    assert label_guard(df, minimum=9).first()["sufficient"] is True
    assert label_guard(df.limit(0)).first()["positives"] == 0
