"""Boosted trees against the same steps in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import boosting


def plain_tree(x, g, h, depth):
    """Splits by node over integer bins ``x``, all candidates compared."""
    rows, out = {0: np.arange(len(g))}, {}
    for _ in range(depth):
        after = {}
        for node, own in rows.items():
            best = None
            for f in range(x.shape[1]):
                for cut in np.unique(x[own, f])[:-1]:
                    low = own[x[own, f] <= cut]
                    high = np.setdiff1d(own, low)
                    score = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)
                    gain = round(score(low) + score(high) - score(own), 6)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, int(cut), low, high)
            if best:
                out[node] = best
                after |= {2 * node + 1: best[3], 2 * node + 2: best[4]}
        rows = after
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 7, (400, 3))
    x[:, 2] = 1
    y = ((x[:, 0] > 3) ^ (rng.random(400) < 0.2)).astype(float)
    rows = [(float(b), *map(int, a)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "label double, _b0 int, _b1 int, _b2 int").repartition(5)


def test_a_tree_is_the_plain_one(table):
    x, y, df = table
    p = 0.3
    margin = f"{np.log(p / (1 - p))!r}D".replace("np.float64(", "").replace(")", "")
    found = boosting.grow_tree(boosting.gradients(df, "label", margin), 3, 3)
    plain = plain_tree(x, y - p, np.full(len(y), p * (1 - p)), 3)
    assert set(found) == set(plain) and len(found) > 3
    for node, (gain, feature, cut, low, high) in plain.items():
        s = found[node]
        assert (s.feature, s.bin, s.left[2], s.right[2]) == (feature, cut, len(low), len(high))
        assert s.gain == pytest.approx(gain) and s.values()[0] == pytest.approx(
            (y - p)[low].sum() / (len(low) * p * (1 - p) + 1))


def test_rounds_equal_plain_rounds(spark, table):
    x, y, df = table
    names = ["a", "b", "c"]
    model = boosting.fit_boosted_trees(df.toDF("label", *names), names, "label", rounds=12, depth=2, step=0.3)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    gains = np.zeros(3)
    for _ in range(12):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        tree = plain_tree(x, g, h, 2)
        for node, (gain, f, _, low, high) in tree.items():
            gains[f] += gain
            for k, rows in ((1, low), (2, high)):
                if 2 * node + k not in tree:
                    margin[rows] += 0.3 * g[rows].sum() / (h[rows].sum() + 1)
    got = model.transform(spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], "i int, a int, b int, c int"))
    got = {r["i"]: r for r in got.collect()}
    assert [got[i]["rawPrediction"] for i in range(len(y))] == pytest.approx(margin.tolist())
    assert all(got[i]["prediction"] == float(margin[i] > 0) for i in range(len(y)))
    assert list(model.gains) == pytest.approx(gains.tolist(), abs=1e-4) and model.gains[2] == 0


def test_edges_and_bins(spark):
    df = spark.createDataFrame([(v, 5.0) for v in [0.0, 1.0, 2.0, 3.0, 4.0, 8.0]], "v double, same double")
    assert boosting.equal_edges(df, ["v", "same"], 4) == [[2.0, 4.0, 6.0], [5.0] * 3]
    binned = boosting.bins(df, ["v", "same"], [[2.0, 4.0, 6.0], []]).orderBy("v").collect()
    assert [r["_b0"] for r in binned] == [0, 0, 0, 1, 1, 3] and {r["_b1"] for r in binned} == {0}
    (edges,) = boosting.quantile_edges(spark.range(1_000).withColumn("v", F.col("id") % 4), ["v"], 32)
    assert edges == [0.0, 1.0, 2.0, 3.0]
    assert boosting.quantile_edges(df.limit(0), ["v"], 4) == [[]]


def test_nothing_to_split(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (1.0, 1)], "label double, a int")
    model = boosting.fit_boosted_trees(df, ["a"], "label", rounds=3)
    assert len(model.nodes) == 0
    assert model.transform(df).first()["probability"] == pytest.approx(2 / 3)


def test_rows_lie_in_files_of_bounded_size(spark, table, monkeypatch):
    _, _, df = table
    stored, write = [], boosting.materialize
    monkeypatch.setattr(boosting, "FILE_ROWS", 100)
    monkeypatch.setattr(boosting, "materialize", lambda rows, name: stored.append(write(rows, name)) or stored[-1])
    boosting.fit_boosted_trees(df.toDF("label", "a", "b", "c"), ["a", "b", "c"], "label", rounds=10, depth=1)
    assert [len(rows.inputFiles()) for rows in stored] == [5, 5]


def test_predictions_are_no_walk_of_arrays(spark, table):
    _, _, df = table
    model = boosting.fit_boosted_trees(df.toDF("label", "a", "b", "c"), ["a", "b", "c"], "label", rounds=2)
    rows = spark.createDataFrame([(None, 1, 1), (9, None, 1)], "a int, b int, c int")
    scored = model.transform(rows)
    plan = scored._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    # A missing value is not below any threshold, so it goes where the greatest one does.
    first, second = (r["rawPrediction"] for r in scored.collect())
    assert first == pytest.approx(model.transform(rows.na.fill(9)).first()["rawPrediction"]) and second is not None
