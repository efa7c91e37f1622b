import collections
import hashlib
import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usagelens.operators import users
from usagelens.operators.causal import diff_in_diff, rollout_panel
from usagelens.operators.churn import train_churn
from usagelens.operators.isolation_forest import (
    average_path, draw_subsamples, fit_isolation_forest, grow_trees, path_lengths,
)
from usagelens.operators.measures import user_days
from usagelens.operators.splits import stratified_split
from usagelens.operators.survival import kaplan_meier

SETTINGS = dict(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


# Survival


def brute_force_curve(subjects):
    out, s = [(0.0, 1.0)], 1.0
    for t in sorted({d for d, _ in subjects}):
        risk = sum(d >= t for d, _ in subjects)
        ends = sum(d == t and e for d, e in subjects)
        s *= 1 - ends / risk
        out.append((float(t), s))
    return out


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 1)), min_size=2, max_size=25))
def test_survival_equals_brute_force(spark, subjects):
    df = spark.createDataFrame([("free", *s) for s in subjects],
                               "user_tier string, lifetime_days int, churned int")
    got = [(r["timeline"], r["survival_prob"]) for r in kaplan_meier(df).collect()]
    want = brute_force_curve(subjects)
    assert [t for t, _ in got] == [t for t, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want])
    probabilities = [s for _, s in got]
    assert probabilities == sorted(probabilities, reverse=True) and probabilities[-1] >= 0


def test_last_subjects_end_and_single_subjects_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", 3, 1), ("a", 5, 1), ("b", 4, 1), ("c", None, 1), ("c", 2, 0), ("c", 2, 0)],
        "user_tier string, lifetime_days int, churned int")
    got = [(r["user_tier"], r["timeline"], r["survival_prob"]) for r in kaplan_meier(df).collect()]
    assert got == [("a", 0.0, 1.0), ("a", 3.0, 0.5), ("a", 5.0, 0.0), ("c", 0.0, 1.0), ("c", 2.0, 1.0)]


# Users


def test_features_take_the_latest_tier_and_the_label_rule(spark, make_events):
    events = make_events([
        {"user_id": "a", "timestamp": "2024-01-01 08:00:00", "user_tier": "free", "churn_day": 5},
        {"user_id": "a", "timestamp": "2024-01-01 09:00:00", "user_tier": "pro", "churn_day": 5,
         "status_code": 500, "latency_ms": 30.0},
        {"user_id": "b", "timestamp": "2024-01-03 09:00:00", "churn_day": 5},
        {"user_id": "c", "timestamp": "2024-01-01 09:00:00"},
    ])
    rows = {r["user_id"]: r for r in users.churn_features(events, "2024-01-08").collect()}
    a = rows["a"]
    assert (a["user_tier"], a["total_requests"], a["avg_latency"], a["error_count"]) == ("pro", 2, 20.0, 1)
    assert (a["active_days"], a["days_since_last"], a["churned"]) == (1, 7, 1)
    assert (a["tier_enterprise"], a["tier_free"], a["tier_pro"]) == (0, 0, 1)
    # Exactly churn_day days away is not yet churned, and without a churn day nobody is.
    assert rows["b"]["days_since_last"] == 5 and rows["b"]["churned"] == 0
    assert rows["c"]["churned"] == 0
    rollup = users.churn_features(user_days(events), "2024-01-08")
    assert sorted(rollup.collect()) == sorted(rows.values())


def test_lifetimes_count_a_user_once_per_tier(spark, make_events):
    events = make_events([
        {"user_id": "a", "timestamp": "2024-01-01 08:00:00"},
        {"user_id": "a", "timestamp": "2024-01-04 08:00:00"},
        {"user_id": "a", "timestamp": "2024-01-21 09:00:00", "user_tier": "pro"},
    ])
    got = {r["user_tier"]: (r["lifetime_days"], r["churned"])
           for r in users.user_lifetimes(events, "2024-01-31", 10).collect()}
    assert got == {"free": (4, 1), "pro": (1, 0)}


def test_durations_that_are_no_numbers_are_dropped(spark):
    df = spark.createDataFrame([("3",), ("x",), (None,)], "lifetime_days string")
    assert [r[0] for r in users.numeric_durations(df).collect()] == [3.0]


def test_one_hot_of_null_and_unknown_values(spark):
    df = spark.createDataFrame([("b",), (None,), ("z",)], "t string")
    out = users.one_hot(df, "t", ["b", "a"], "t")
    assert out.columns == ["t", "t_a", "t_b"]
    assert [(r["t_a"], r["t_b"]) for r in out.collect()] == [(0, 1), (0, 0), (0, 0)]


# Split


@pytest.mark.parametrize("test", [0.0, 0.3, 1.0])
def test_split_is_exact_per_label(spark, test):
    df = spark.range(3_000).selectExpr("id AS user_id", "if(id % 11 = 0, 1, 0) AS churned")
    got = stratified_split(df, "churned", "user_id", test).collect()
    by_label = collections.defaultdict(list)
    for r in got:
        by_label[r["churned"]].append(r)
    assert len(got) == 3_000
    for rows in by_label.values():
        k = math.floor(len(rows) * test + 0.5)
        rows.sort(key=lambda r: hashlib.md5(f"{r['user_id']}|42".encode()).hexdigest())
        assert [r["is_test"] for r in rows] == [True] * k + [False] * (len(rows) - k)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id AS user_id", "id % 2 AS churned")
    first = stratified_split(df, "churned", "user_id").collect()
    second = stratified_split(df.repartition(7), "churned", "user_id").collect()
    assert sorted(first) == sorted(second)
    other = stratified_split(df, "churned", "user_id", seed=1).collect()
    assert sorted(first) != sorted(other)


def test_split_by_hash_alone(spark):
    df = spark.range(20_000).selectExpr("id AS user_id", "id % 2 AS churned")
    share = stratified_split(df, "churned", "user_id", exact=False).agg(
        F.avg(F.col("is_test").cast("int"))).first()[0]
    assert share == pytest.approx(0.3, abs=0.02)


# Difference in differences


def test_effect_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(bool(i % 2), bool(i // 2 % 2), float(v)) for i, v in enumerate(rng.normal(5, 2, 200))]
    got = diff_in_diff(spark.createDataFrame(rows, "treated boolean, post boolean, y double"), "y").first()
    cell = {(t, p): [y for a, b, y in rows if (a, b) == (t, p)] for t in (0, 1) for p in (0, 1)}
    mean = {k: statistics.mean(v) for k, v in cell.items()}
    did = (mean[1, 1] - mean[1, 0]) - (mean[0, 1] - mean[0, 0])
    se = math.sqrt(sum(statistics.variance(v) / len(v) for v in cell.values()))
    assert got["did"] == pytest.approx(did) and got["se"] == pytest.approx(se)
    assert got["t_stat"] == pytest.approx(did / se)


def test_panel_keeps_treated_and_both_control_groups(spark):
    df = spark.createDataFrame(
        [("enterprise", "us", "2024-01-14"), ("enterprise", "eu", "2024-01-15"),
         ("free", "us", "2024-01-16"), ("free", "eu", "2024-01-16")],
        "user_tier string, region string, d string").withColumn("event_date", F.to_date("d"))
    got = {(r["user_tier"], r["region"]): (r["treated"], r["post"])
           for r in rollout_panel(df, "2024-01-15", "enterprise", "us").collect()}
    assert got == {("enterprise", "us"): (True, False), ("enterprise", "eu"): (False, True),
                   ("free", "us"): (False, True)}


def test_an_empty_cell_gives_no_effect(spark):
    df = spark.createDataFrame([(True, True, 1.0)], "treated boolean, post boolean, y double")
    got = diff_in_diff(df, "y").first()
    assert got["treated_post_n"] == 1 and got["did"] is None and got["se"] is None


# Isolation forest


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(rng.normal(0, 1, (2_000, 2)))]
    rows.append((9_999, 25.0, -25.0, 1.0))
    rows.append((10_000, None, 0.0, 1.0))
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double").repartition(4)


def test_outlier_ranks_first_and_the_share_is_kept(spark, points):
    model = fit_isolation_forest(points, ["a", "b", "c"], "id", trees=40, subsample=128)
    scored = model.transform(points.na.drop()).toPandas()
    assert len(scored) == 2_001
    assert scored["anomaly_score"].between(0, 1, inclusive="neither").all()
    assert scored.sort_values("anomaly_score").iloc[-1]["id"] == 9_999
    assert scored["is_anomaly"].mean() == pytest.approx(0.05, abs=0.005)
    again = fit_isolation_forest(points.repartition(3), ["a", "b", "c"], "id", trees=40, subsample=128)
    assert again.threshold == pytest.approx(model.threshold)


def test_subsamples_have_the_exact_size(spark, points):
    drawn = draw_subsamples(points.na.drop(), ["a", "b"], "id", 2_001, 10, 128, 7)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {128}
    assert drawn.select("tree", "id").distinct().count() == 1_280


def test_trees_split_every_row_and_respect_the_depth(spark, points):
    drawn = draw_subsamples(points.na.drop(), ["a", "b"], "id", 2_001, 3, 64, 7)
    nodes = grow_trees(drawn, ["a", "b"], 64, 7).toPandas()
    for _, tree in nodes.groupby("tree"):
        leaves = tree[tree["feature"] < 0]
        assert len(tree) == 2 * len(leaves) - 1 and len(tree) < 2 * 64
        assert (leaves["path"] >= 1).all() and (leaves["path"] <= 6 + average_path(64)).all()


def test_scores_equal_a_walk_in_plain_python(spark, points):
    drawn = draw_subsamples(points.na.drop(), ["a", "b"], "id", 2_001, 5, 64, 7)
    nodes = grow_trees(drawn, ["a", "b"], 64, 7)
    tree = {(n.tree, n.node): n for n in nodes.toPandas().itertuples()}
    some = points.limit(200).union(points.where("id > 9000"))
    for r in path_lengths(some, nodes, ["a", "b"], 6).collect():
        total = 0
        for t in range(5):
            at = tree[t, 0]
            while at.feature >= 0:
                value = r[("a", "b")[at.feature]]
                at = tree[t, at.left if value is not None and value <= at.threshold else at.right]
            total += at.path
        assert r["path_length"] == pytest.approx(total / 5)
    plan = path_lengths(points, nodes, ["a", "b"], 6)._jdf.queryExecution().executedPlan().toString()
    assert "mapInPandas" not in plan.split("FlatMapGroupsInPandas")[0] and "BroadcastNestedLoopJoin" in plan


def test_constant_and_tiny_data(spark):
    same = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, a double")
    model = fit_isolation_forest(same, ["a"], "id", trees=5)
    assert not any(r["is_anomaly"] for r in model.transform(same).collect())
    assert model.transform(same.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fit_isolation_forest(same.limit(0), ["a"], "id")


# Churn model


def test_churn_model_learns_and_reports_what_it_measures(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(x), float(z), int(x > 0.6)) for i, (x, z) in enumerate(rng.random((300, 2)))]
    df = spark.createDataFrame(rows, "user_id int, x double, z double, churned int")
    model = train_churn(df, ["x", "z"], rounds=5)
    importances = {r["feature"]: r["importance"] for r in model.importances().collect()}
    assert sum(importances.values()) == pytest.approx(1) and importances["x"] > 0.9
    metrics = {r["metric"]: r["value"] for r in model.metrics().collect()}
    assert metrics["accuracy"] > 0.9 and metrics["roc_auc"] > 0.9


def test_churn_labels_are_never_made_up(spark):
    df = spark.createDataFrame([(i, 1.0, 0) for i in range(20)], "user_id int, x double, churned int")
    with pytest.raises(ValueError, match="both labels"):
        train_churn(df, ["x"], rounds=2)
