import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from usagelens.operators.rank_select import exact_percentile, percentile

VALUES = st.one_of(
    st.integers(-5, 5).map(float),
    st.floats(-1e9, 1e9, allow_nan=False),
    st.floats(0, 1e-12, allow_nan=False),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.lists(st.lists(VALUES, min_size=1, max_size=40), min_size=1, max_size=3),
    p=st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]),
)
def test_equals_numpy(spark, groups, p):
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["x"] for r in exact_percentile(df, ["g"], "v", p, "x").collect()}
    assert set(got) == set(range(len(groups)))
    for g, values in enumerate(groups):
        assert got[g] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)


def test_nulls_are_ignored_and_a_null_key_is_a_group(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0), ("b", None)], "g string, v double")
    got = {r["g"]: r["x"] for r in exact_percentile(df, ["g"], "v", 0.5, "x").collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_percentile(df, ["g"], "v", 0.5, "x").count() == 0
    assert exact_percentile(df, [], "v", 0.5, "x").first()["x"] is None


def test_one_group_with_most_rows(spark):
    df = spark.range(60_000).selectExpr(
        "if(id % 3 > 0, 'hot', concat('k', id % 50)) AS g", "cast(id * 7919 % 30011 as double) AS v")
    pdf = df.toPandas()
    got = {r["g"]: r["x"] for r in exact_percentile(df, ["g"], "v", 0.95, "x").collect()}
    want = pdf.groupby("g")["v"].quantile(0.95).to_dict()
    assert got == pytest.approx(want)


def test_many_groups(spark):
    df = spark.range(4_000).selectExpr(
        "if(id % 40 = 7, null, id % 40) AS g", "cast(id * 37 % 1009 as double) / 7 - 50 AS v")
    want = df.toPandas().groupby("g", dropna=False)["v"].quantile(0.9)
    want = {None if np.isnan(g) else int(g): v for g, v in want.items()}
    got = {r["g"]: r["x"] for r in exact_percentile(df, ["g"], "v", 0.9, "x").collect()}
    assert got == pytest.approx(want) and len(got) == 40


def test_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", v) for v in (-inf, 1.0, 2.0, inf, nan)] + [("b", v) for v in (inf, inf, -1e308)]
    df = spark.createDataFrame(rows, "g string, v double")

    def at(p):
        return {r["g"]: r["x"] for r in exact_percentile(df, ["g"], "v", p, "x").collect()}

    assert at(0.0) == {"a": -inf, "b": -1e308}
    assert at(0.5) == {"a": 2.0, "b": inf}
    assert at(0.75)["a"] == inf and np.isnan(at(1.0)["a"])


def test_approximate_is_close(spark):
    df = spark.range(10_000).selectExpr("1 AS g", "cast(id as double) AS v")
    got = percentile(df, ["g"], "v", 0.95, "x", approx=True).first()["x"]
    assert got == pytest.approx(9499, abs=5)
