"""Isolation forest (Liu, Ting, Zhou 2008) on Spark.

Each tree is grown on a small random subsample, so training needs one pass that draws the
subsamples and then one small task per tree. Scoring is a column expression over the finished trees,
whose size is bounded by ``trees * 2 * subsample`` nodes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.operators.rank_select import exact_percentile
from usagelens.session import materialize

#: A row per node. Nodes of a tree are numbered from 0, its root; a leaf has the feature -1, leads to
#: itself, and has the length of the path to it, with what rows left together in it would add.
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double"
)


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of ``n`` keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def draw_subsamples(
    df: DataFrame, features: Sequence[str], key: str, n: int, trees: int, size: int, seed: int
) -> DataFrame:
    """``size`` rows per tree, drawn without replacement by hash of key, tree and seed.

    A row first joins a tree with a probability a little above ``size / n``, so only about
    ``trees * size`` rows reach the ranking, which then keeps exactly ``size`` of them.
    """
    rate = min(1.0, (size + 10.0 * math.sqrt(size)) / max(n, 1))
    span = 1 << 40

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(key), tree, F.lit(seed)), F.lit(span))

    # A row's trees are chosen inside the row, so only chosen pairs become rows.
    joined = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < int(rate * span))
    drawn = df.select(key, *features, F.explode(joined).alias("tree")).withColumn("draw", draw(F.col("tree")))
    order = W.partitionBy("tree").orderBy("draw", key)
    return drawn.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= size)


def grow_trees(sample: DataFrame, features: Sequence[str], size: int, seed: int) -> DataFrame:
    """Node table of one random tree per ``tree``."""
    features = list(features)
    limit = max(1, math.ceil(math.log2(max(size, 2))))
    rest_of_path = [average_path(n) for n in range(size + 1)]

    def grow(pdf):
        import numpy as np

        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = pdf.sort_values("r")[features].to_numpy(dtype="float64")
        nodes = []
        todo = [(np.arange(len(x)), 0, -1, "")]
        while todo:
            rows, depth, parent, side = todo.pop()
            node = len(nodes)
            if parent >= 0:
                nodes[parent][side] = node
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            entry = {"tree": tree, "node": node, "feature": -1, "threshold": 0.0,
                     "left": node, "right": node, "path": depth + rest_of_path[len(rows)]}
            nodes.append(entry)
            if depth >= limit or len(rows) <= 1 or len(usable) == 0:
                continue
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            goes_left = x[rows, f] <= cut
            entry.update(feature=f, threshold=cut, path=0.0)
            todo.append((rows[~goes_left], depth + 1, node, "right"))
            todo.append((rows[goes_left], depth + 1, node, "left"))
        return pd.DataFrame(nodes)

    return sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def path_lengths(df: DataFrame, nodes: DataFrame, features: Sequence[str], depth: int) -> DataFrame:
    """``df`` with ``path_length``, the mean over the trees of ``nodes`` of the path to each row's leaf.

    The forest is one row of arrays, trees laid end to end, which is broadcast: its size is that of the
    forest, bounded by trees and subsample. Each row walks down every tree by column expressions, at
    most ``depth`` steps. A row without a feature's value goes to the right, as it is not below any
    threshold. A null sum of nothing: without trees there is no length.
    """
    laid = nodes.withColumn("at", F.row_number().over(W.orderBy("tree", "node")) - 1)
    laid = laid.withColumn("base", F.col("at") - F.col("node"))
    columns = {
        "feature": F.greatest("feature", F.lit(0)), "threshold": F.col("threshold"), "path": F.col("path"),
        "left": F.col("left") + F.col("base"), "right": F.col("right") + F.col("base"),
    }
    row = F.struct("at", *[c.alias(n) for n, c in columns.items()], (F.col("node") == 0).alias("root"))
    forest = laid.agg(F.array_sort(F.collect_list(row)).alias("_n"))
    forest = forest.select(*[F.col(f"_n.{c}").alias(f"_{c}") for c in columns],
                           F.expr("filter(_n, n -> n.root).at").alias("_roots"))
    values = F.array(*[F.col(f).cast("double") for f in features])

    def down(at: Column, _: Column) -> Column:
        below = F.get("_x", F.get("_feature", at)) <= F.get("_threshold", at)
        return F.when(below, F.get("_left", at)).otherwise(F.get("_right", at))

    steps = F.sequence(F.lit(1), F.lit(depth))
    total = F.aggregate("_roots", F.lit(0.0), lambda s, root: s + F.get("_path", F.aggregate(steps, root, down)))
    joined = df.withColumn("_x", values).crossJoin(F.broadcast(forest))
    return joined.select(*df.columns, F.try_divide(total, F.size("_roots").cast("double")).alias("path_length"))


@dataclass(frozen=True)
class IsolationForestModel:
    features: tuple[str, ...]
    nodes: pd.DataFrame
    subsample: int
    threshold: float | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` in (0, 1); rows easier to isolate score higher."""
        nodes = df.sparkSession.createDataFrame(self.nodes, NODE_SCHEMA)
        scored = path_lengths(df, nodes, self.features, max(1, math.ceil(math.log2(max(self.subsample, 2)))))
        norm = average_path(self.subsample) or 1.0
        return scored.withColumn("anomaly_score", F.pow(F.lit(2.0), -F.col("path_length") / norm)).drop("path_length")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly``."""
        if self.threshold is None:
            raise ValueError("the model has no threshold; fit it first")
        return self.score(df).withColumn("is_anomaly", F.col("anomaly_score") > self.threshold)


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    trees: int = 100,
    subsample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
) -> IsolationForestModel:
    """Fit on rows without nulls; the share ``contamination`` of them scores above the threshold.

    ``key`` must identify a row. The rows are read several times, so pass a stored table rather
    than a long plan. Only the finished trees and the threshold come to the driver.
    """
    rows = df.na.drop(subset=[key, *features]).select(key, *features)
    n = rows.count()
    if n == 0:
        raise ValueError("no complete rows to fit on")
    size = min(subsample, n)
    sample = draw_subsamples(rows, features, key, n, trees, size, seed)
    nodes = grow_trees(sample, features, size, seed).toPandas()
    model = IsolationForestModel(tuple(features), nodes, size)
    # Scored once and stored, as the percentile reads the scores more than once.
    scores = materialize(model.score(rows).select("anomaly_score"), "anomaly-scores")
    cut = exact_percentile(scores, [], "anomaly_score", 1.0 - contamination, "cut")
    return IsolationForestModel(tuple(features), nodes, size, cut.first()["cut"])
