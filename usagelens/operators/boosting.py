"""Gradient-boosted trees for labels 0 and 1, with one aggregation for each level of a tree.

Features are cut into bins once. A level sums the gradients and their weights of the rows by node,
feature and bin, combined before the shuffle; from these sums, of which there are nodes times features
features and bins, the driver takes each node's best split. Rows keep their bins and their margin only. The
margin grows in the tasks by the trees that came since and is written anew from time to time, so that
a level costs a few trees at most and so does a lost executor. Tasks sum their rows with numpy, and rows lie in files of
bounded size, so that a level has as many tasks as the rows ask for.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.operators.isolation_forest import NODE_SCHEMA
from usagelens.session import materialize

#: Added to the weights of a side, and the decimals to which gains are compared.
PENALTY, DECIMALS = 1.0, 6
#: Trees between two writes of the margin, and rows of a file of them.
STORED, FILE_ROWS = 10, 50_000
#: What tasks give of a level: sums of the rows of a node in a bin of a feature.
CELL_SCHEMA = "node int, feature int, bin int, gradient double, weight double, rows long"


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` whose feature's bin is ``bin`` at most go to node 2n + 1, others to 2n + 2.

    ``left`` and ``right`` are (sum of gradients, sum of weights, rows).
    """

    node: int
    feature: int
    bin: int
    gain: float
    left: tuple[float, float, int]
    right: tuple[float, float, int]

    def values(self) -> tuple[float, float]:
        """The best margins to add on both sides."""
        return tuple(g / (h + PENALTY) for g, h, _ in (self.left, self.right))


#: A finished tree: its splits, and what its leaves add to the margin.
Addition = tuple[dict[int, Split], dict[int, float]]


def bins(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``_b0, _b1, ...``: how many edges of its feature a row's value is greater than."""

    def count(feature: str, cuts: Sequence[float]) -> Column:
        value = F.col(feature).cast("double")
        return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda e: e < value)) if len(cuts) else F.lit(0)

    return df.withColumns({f"_b{i}": count(f, e) for i, (f, e) in enumerate(zip(features, edges, strict=True))})


def quantile_edges(df: DataFrame, features: Sequence[str], count: int) -> list[list[float]]:
    """Edges that cut each feature into up to ``count`` bins of about as many rows, in one pass."""
    shares = [k / count for k in range(1, count)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10_000) for f in features]).first()
    return [sorted(set(cuts or [])) for cuts in row]


def equal_edges(df: DataFrame, features: Sequence[str], count: int) -> list[list[float]]:
    """Edges that cut the range of each feature into ``count`` bins of one width."""
    ends = [f(F.col(c).cast("double")) for c in features for f in (F.min, F.max)]
    row = df.agg(*ends).first()
    return [[low + (high - low) * k / count for k in range(1, count)] if low is not None else []
            for low, high in zip(row[::2], row[1::2])]


def best_split(node: int, sums: dict[int, dict[int, tuple[float, float, int]]]) -> Split | None:
    """The split of most gain from a node's sums by feature and bin; ties to the first feature and bin."""
    best = None
    for feature in sorted(sums):
        of = sorted(sums[feature].items())
        total = [sum(v[k] for _, v in of) for k in range(3)]
        left = [0.0, 0.0, 0]
        for at, value in of[:-1]:
            left = [a + b for a, b in zip(left, value)]
            right = [a - b for a, b in zip(total, left)]
            gain = round(sum(g * g / (h + PENALTY) for g, h, _ in (left, right))
                         - total[0] ** 2 / (total[1] + PENALTY), DECIMALS)
            if gain > 0 and (best is None or gain > best.gain):
                best = Split(node, feature, at, gain, tuple(left), tuple(right))
    return best


def tree_case(splits: dict[int, Split], leaf, node: int = 0) -> str:
    """SQL that leads a row down the tree; ``leaf`` gives what stands at a node without a split."""
    if node not in splits:
        return leaf(node)
    split = splits[node]
    left, right = (tree_case(splits, leaf, 2 * node + k) for k in (1, 2))
    return f"CASE WHEN _b{split.feature} <= {split.bin} THEN {left} ELSE {right} END"


def nodes_of(bins: np.ndarray, splits: dict[int, Split]) -> np.ndarray:
    """The node that each row of ``bins`` ends at."""
    node = np.zeros(len(bins), np.int64)
    for n in sorted(splits):
        own = np.flatnonzero(node == n)
        node[own] = 2 * n + 1 + (bins[own, splits[n].feature] > splits[n].bin)
    return node


def cell_sums(
    level: Sequence[int], splits: dict[int, Split], features: int, added: Sequence[Addition],
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Sums of a task's rows by node of ``level``, feature and bin; see :func:`grow_tree`."""
    first, nodes = min(level), max(level) - min(level) + 1
    names = [f"_b{i}" for i in range(features)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, nodes, features, 0))
        for batch in batches:
            bins = batch[names].to_numpy(np.int64)
            if "gradient" in batch:
                gradient, weight = (batch[c].to_numpy(np.float64) for c in ("gradient", "weight"))
            else:
                margin = batch["margin"].to_numpy(np.float64)
                for tree, values in added:
                    at = np.zeros(max(values) + 1)
                    at[list(values)] = list(values.values())
                    margin = margin + at[nodes_of(bins, tree)]
                p = 1 / (1 + np.exp(-margin))
                gradient, weight = batch["label"].to_numpy(np.float64) - p, p * (1 - p)
            node = nodes_of(bins, splits)
            own = np.isin(node, level)
            if not own.any():
                continue
            bins, node = bins[own], node[own]
            if (more := int(bins.max()) + 1 - total.shape[-1]) > 0:
                total = np.pad(total, ((0, 0), (0, 0), (0, 0), (0, more)))
            cell = (((node - first)[:, None] * features + np.arange(features)) * total.shape[-1] + bins).ravel()
            for k, values in enumerate((gradient, weight, None)):
                weights = None if values is None else np.repeat(values[own], features)
                total[k] += np.bincount(cell, weights, total[k].size).reshape(total[k].shape)
        node, feature, at = np.nonzero(total[2])
        sums = dict(zip(("gradient", "weight", "rows"), total[:, node, feature, at]))
        yield pd.DataFrame({"node": node + first, "feature": feature, "bin": at, **sums}).astype({"rows": "int64"})

    return run


def grow_tree(rows: DataFrame, features: int, depth: int, added: Sequence[Addition] = ()) -> dict[int, Split]:
    """Splits by node, the root being 0, of ``rows`` (gradient, weight, _b0, _b1, ...).

    In place of the first two ``rows`` may have label and margin, to which the trees ``added`` still come.
    Trees are given to the tasks as data: the plan is the same for every level, so its code is compiled once.
    """
    splits: dict[int, Split] = {}
    level = [0]
    given = ("gradient", "weight") if "gradient" in rows.columns else ("label", "margin")
    cells = rows.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in given],
                        *[F.col(f"_b{i}").cast("short").alias(f"_b{i}") for i in range(features)])
    for _ in range(depth):
        summed = cells.mapInPandas(cell_sums(level, splits, features, added), CELL_SCHEMA).groupBy(
            "node", "feature", "bin").agg(F.sum("gradient"), F.sum("weight"), F.sum("rows"))
        sums = defaultdict(lambda: defaultdict(dict))
        for node, feature, at, *values in summed.collect():
            sums[node][feature][at] = tuple(values)
        found = [s for s in (best_split(n, sums[n]) for n in sorted(sums)) if s]
        splits |= {s.node: s for s in found}
        level = [2 * s.node + k for s in found for k in (1, 2)]
        if not level:
            break
    return splits


def leaf_values(splits: dict[int, Split]) -> dict[int, float]:
    out = {}
    for s in splits.values():
        out |= {2 * s.node + 1 + k: v for k, v in enumerate(s.values()) if 2 * s.node + 1 + k not in splits}
    return out


def leaf_sum(nodes: pd.DataFrame, depth: int) -> Callable[[pd.DataFrame], pd.Series]:
    """For rows of features the sum over all trees of what their leaves hold.

    A row without a feature's value goes to the right, as it is not below any threshold.
    """
    laid = nodes.sort_values(["tree", "node"], ignore_index=True)
    base = laid.index.to_numpy() - laid["node"].to_numpy()
    roots = np.flatnonzero(laid["node"] == 0)
    left, right = (laid[side].to_numpy() + base for side in ("left", "right"))
    feature, threshold, path = np.maximum(laid["feature"].to_numpy(), 0), laid["threshold"].to_numpy(), laid["path"].to_numpy()

    def run(values: pd.DataFrame) -> pd.Series:
        x, every = values.to_numpy(np.float64), np.arange(len(values))
        total = np.zeros(len(values))
        for root in roots:
            at = np.full(len(values), root)
            for _ in range(depth):
                at = np.where(x[every, feature[at]] <= threshold[at], left[at], right[at])
            total += path[at]
        return pd.Series(total)

    return run


@dataclass(frozen=True)
class BoostedTrees:
    """``nodes``: all trees as a forest's node table, leaves holding what they add to the margin."""

    features: tuple[str, ...]
    nodes: pd.DataFrame
    gains: tuple[float, ...]
    base: float
    depth: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``rawPrediction`` (the margin), ``probability`` of label 1, and ``prediction``."""
        margin = F.lit(self.base)
        if len(self.nodes):
            values = F.struct(*[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(self.features)])
            run = leaf_sum(self.nodes, self.depth)

            @F.pandas_udf("double")
            def leaves(values: pd.DataFrame) -> pd.Series:
                return run(values)

            margin = leaves(values) + self.base
        return df.withColumn("rawPrediction", margin).withColumns({
            "probability": 1 / (1 + F.exp(-F.col("rawPrediction"))),
            "prediction": (F.col("rawPrediction") > 0).cast("double"),
        })


def _node_rows(tree: int, splits: dict[int, Split], edges: Sequence[Sequence[float]], step: float) -> list[tuple]:
    values = leaf_values(splits)
    number = {n: i for i, n in enumerate(sorted([*splits, *values]))}
    out = []
    for n, i in number.items():
        if s := splits.get(n):
            out.append((tree, i, s.feature, edges[s.feature][s.bin], number[2 * n + 1], number[2 * n + 2], 0.0))
        else:
            out.append((tree, i, -1, 0.0, i, i, step * values[n]))
    return out


def gradients(rows: DataFrame, label: str, margin: str) -> DataFrame:
    """``rows`` with the gradient and the weight of the logistic loss at a margin."""
    p = 1 / (1 + F.exp(-F.expr(margin)))
    return rows.withColumns({"gradient": F.col(label) - p, "weight": p * (1 - p)})


def fit_boosted_trees(
    df: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 3, step: float = 0.1,
    most_bins: int = 32,
) -> BoostedTrees:
    """Fit on rows without nulls in ``features``; labels are 0 and 1, and both occur.

    The result does not depend on the order of rows or partitions, but for the last digits of sums.
    """
    features = list(features)
    edges = quantile_edges(df, features, most_bins)
    share, size = df.agg(F.avg(F.col(label).cast("double")), F.count("*")).first()
    base = math.log(share / (1 - share))
    names = [f"_b{i}" for i in range(len(features))]
    # A file is read by one task at least, so its rows are bounded.
    files = size // FILE_ROWS + 1
    rows = materialize(bins(df, features, edges).select(
        F.col(label).cast("double").alias("label"), *[F.col(b).cast("short").alias(b) for b in names],
        F.lit(base).alias("margin")).repartition(files), "boosting")
    added, nodes, gains = [], [], [0.0] * len(features)
    for number in range(rounds):
        splits = grow_tree(rows, len(features), depth, added)
        if not splits:
            break
        added.append((splits, {n: step * v for n, v in leaf_values(splits).items()}))
        nodes += _node_rows(number, splits, edges, step)
        for s in splits.values():
            gains[s.feature] += s.gain
        if number % STORED == STORED - 1:
            margin = " + ".join(["margin", *[tree_case(s, lambda n: repr(v[n]) + "D") for s, v in added]])
            rows, added = materialize(rows.withColumn("margin", F.expr(margin)).repartition(files), "boosting"), []
    columns = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
    return BoostedTrees(tuple(features), pd.DataFrame(nodes, columns=columns), tuple(gains), base, depth)
