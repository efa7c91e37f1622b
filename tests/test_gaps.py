import datetime as dt

from usagelens.operators import gaps

START, END = dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 3, 0, 10, 30)


def slots(df):
    return [r["slot"] for r in df.orderBy("slot").collect()]


def expected(start=START, end=END, seconds=60):
    out = []
    while start < end:
        out.append(start)
        start += dt.timedelta(seconds=seconds)
    return out


def bounds(spark, start=START, end=END):
    return spark.createDataFrame([(str(start), str(end))], "s string, e string").selectExpr(
        "cast(s as timestamp) AS start", "cast(e as timestamp) AS end")


def test_calendar_is_half_open(spark):
    for seconds in (60, 10, 3600):
        got = slots(gaps.slot_calendar(spark, START, END, seconds))
        assert got == expected(seconds=seconds)
    assert slots(gaps.slots_between(bounds(spark))) == expected()
    assert slots(gaps.slots_between(bounds(spark), 10)) == expected(seconds=10)


def test_window_ends_after_the_current_minute(spark):
    start, end = gaps.slot_window(dt.datetime(2024, 3, 1, 10, 30, 59, 5))
    assert end == dt.datetime(2024, 3, 1, 10, 31) and start == dt.datetime(2023, 12, 2, 10, 31)
    assert gaps.slot_calendar(spark, start, end).count() == 90 * 24 * 60


def test_empty_span(spark):
    assert gaps.slot_calendar(spark, END, START).count() == 0
    assert gaps.slots_between(bounds(spark, END, START)).count() == 0


def test_missing_and_existing_make_up_the_calendar(spark, make_events):
    events = make_events([
        {"timestamp": "2024-01-01 23:50:00"}, {"timestamp": "2024-01-01 23:50:59"},
        {"timestamp": "2024-01-02 12:00:30"}, {"timestamp": "2024-01-03 00:10:29"},
        {"timestamp": "2024-01-03 00:11:00"}, {"timestamp": "2024-01-01 23:49:59"},
    ])
    calendar = gaps.slot_calendar(spark, START, END)
    existing = gaps.existing_slots(events, START, END)
    missing = gaps.missing_slots(calendar, existing)
    found, gone = set(slots(existing)), set(slots(missing))
    assert len(found) == 3 and not found & gone and found | gone == set(expected())
    row = gaps.slot_coverage(calendar, existing).first()
    assert (row["expected"], row["existing"], row["missing"]) == (len(expected()), 3, len(gone))


def test_backfill_is_appended_by_name(spark):
    missing = gaps.backfill_keys(gaps.slot_calendar(spark, START, END))
    extra = spark.createDataFrame([("x", "u")], "event_id string, user_id string")
    both = gaps.append_events(missing, extra)
    assert both.count() == len(expected()) + 1
    assert both.select("event_id").distinct().count() == len(expected()) + 1


def test_hourly_profile_counts_days(spark, make_events):
    profile = gaps.hourly_profile(make_events([
        {"timestamp": "2024-01-05 10:00:00"}, {"timestamp": "2024-01-05 10:30:00"},
        {"timestamp": "2024-01-04 10:30:00"}, {"timestamp": "2024-01-06 10:30:00"},
    ])).collect()
    got = [(r["hour"], r["is_weekend"], r["requests"], r["days"], r["requests_per_day"]) for r in profile]
    # Thursday to Saturday: two weekdays and one weekend day, each hour with a row.
    assert len(got) == 48 and {g[3] for g in got if not g[1]} == {2} and {g[3] for g in got if g[1]} == {1}
    assert [g for g in got if g[2]] == [(10, False, 3, 2, 1.5), (10, True, 1, 1, 1.0)]
    assert gaps.hourly_profile(make_events([{}]).limit(0)).count() == 0
