"""The effect with errors clustered by user, against least squares in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.functions.distributions import log_gamma, two_sided_t
from usagelens.operators.causal import diff_in_diff
from usagelens.plans.training import rollout_report

SCHEMA = "user_id long, treated boolean, post boolean, y double"


def plain_p(t, v, steps=200_000):
    """By the trapezoid rule over the angle: u = sqrt(v) tan(a)."""
    a = np.linspace(0, math.atan(abs(t) / math.sqrt(v)), steps + 1)
    f = np.cos(a) ** (v - 1)
    scale = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(math.pi)
    return 1 - 2 * scale * float(np.trapezoid(f, a))


def least_squares(rows):
    """Effect and its cluster-robust error (CR1) from the regression on both flags and their product."""
    rows = [r for r in rows if r[3] is not None]
    users = np.array([-1 if r[0] is None else r[0] for r in rows])
    x = np.array([[1.0, t, p, t * p] for _, t, p, _ in rows])
    y = np.array([r[3] for r in rows])
    bread = np.linalg.inv(x.T @ x)
    beta = bread @ x.T @ y
    u = y - x @ beta
    scores = np.array([(x[users == g] * u[users == g, None]).sum(0) for g in np.unique(users)])
    g, n = len(scores), len(rows)
    v = bread @ scores.T @ scores @ bread * g / (g - 1) * (n - 1) / (n - 4)
    return beta[3], math.sqrt(v[3, 3]), g


def random_rows(seed, users=30, count=900):
    rng = np.random.default_rng(seed)
    level = rng.normal(0, 3, users)
    out = []
    for _ in range(count):
        user = int(rng.integers(users) ** 2 // users)
        # Some users are treated, some are not, and some change sides.
        treated = bool(user % 3 == 0 or (user % 3 == 1 and rng.random() < 0.5))
        post = bool(rng.random() < 0.4)
        y = 100 + level[user] + rng.normal() + treated * post * 1.5
        out.append((user, treated, post, None if rng.random() < 0.05 else float(y)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_clustered_errors_equal_least_squares(spark, seed):
    rows = random_rows(seed) + [(None, True, True, 103.0), (None, False, True, 99.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = diff_in_diff(df, "y", user="user_id").first()
    did, se, users = least_squares(rows)
    assert got["did"] == pytest.approx(did) and got["cluster_se"] == pytest.approx(se)
    assert got["clusters"] == users and got["cluster_t"] == pytest.approx(did / se)
    assert got["p_value"] == pytest.approx(plain_p(did / se, users - 1), abs=1e-8)
    assert got["relative_effect"] == pytest.approx(did / (got["treated_post_mean"] - did))
    independent = diff_in_diff(df, "y").first().asDict()
    assert {k: pytest.approx(v) for k, v in independent.items()} == {k: got[k] for k in independent}


def test_copies_of_a_users_days_do_not_make_the_effect_surer(spark):
    rows = random_rows(3)
    once, often = (diff_in_diff(spark.createDataFrame(r, SCHEMA), "y", user="user_id").first()
                   for r in (rows, rows * 9))
    assert often["cluster_se"] == pytest.approx(once["cluster_se"], rel=0.01) and often["se"] < once["se"] / 2.9


def test_without_enough_to_tell(spark):
    one = spark.createDataFrame([(1, True, True, 1.0)], SCHEMA)
    got = diff_in_diff(one, "y", user="user_id").first()
    assert got["treated_post_n"] == 1 and got["clusters"] == 1
    assert [got[c] for c in ("did", "se", "cluster_se", "cluster_t", "p_value", "relative_effect")] == [None] * 6
    none = diff_in_diff(one.where("false"), "y", user="user_id").first()
    assert none["clusters"] == 0 and none["did"] is None and none["treated_pre_n"] == 0


def test_students_distribution(spark):
    cases = [(t, v) for t in (1e-3, 0.5, 1.0, 1.96, -2.5, 6.0, 30.0) for v in (1, 2, 5, 29, 400, 20_000)]
    df = spark.createDataFrame([(float(t), v) for t, v in cases], "t double, v int")
    for r in df.withColumn("p", two_sided_t(F.col("t"), F.col("v"))).collect():
        assert r["p"] == pytest.approx(plain_p(r["t"], r["v"]), abs=2e-9), r
    odd = spark.createDataFrame([(0.0, 5), (1.0, 0), (None, 5), (1.96, 2_000_000_000)], "t double, v int")
    got = [r["p"] for r in odd.select(two_sided_t(F.col("t"), F.col("v")).alias("p")).collect()]
    assert got[:3] == [1.0, None, None] and got[3] == pytest.approx(math.erfc(1.96 / math.sqrt(2)), abs=1e-6)


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 2.0, 10.0, 1234.5, 5e6]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(log_gamma(F.col("x"))).collect()]
    assert got == pytest.approx([math.lgamma(v) for v in values], rel=1e-12, abs=1e-12)


def test_report_has_the_relative_effect(spark):
    effects = diff_in_diff(spark.createDataFrame(random_rows(4), SCHEMA), "y", user="user_id")
    line = rollout_report(effects.withColumn("outcome", F.lit("y"))).first()["line"]
    row = effects.first()
    assert f"{100 * row['relative_effect']:+.2f}%" in line and f"p {row['p_value']:.4f}; {row['clusters']} users" in line
