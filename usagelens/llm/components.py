"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.session import ensure_checkpoint_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of each node to the least of them and the node itself.

    The large step looks at all neighbours and moves the greater ones; the small step looks at the
    smaller ones. The least neighbour comes from an aggregate that is combined before the shuffle,
    and is joined back, so a node with very many neighbours is no single task.
    """
    if large:
        arcs = edges.union(edges.select("dst", "src"))
    else:
        arcs = edges
    arcs = arcs.toDF("node", "near")
    least = arcs.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("least"))
    joined = arcs.join(least, "node")
    if large:
        moved = joined.where(F.col("near") > F.col("node")).select(
            F.col("near").alias("src"), F.col("least").alias("dst"))
    else:
        moved = joined.select(F.explode(F.array("near", "node")).alias("src"), F.col("least").alias("dst"))
    return moved.where("src <> dst").distinct()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root: the least node of its component) for the nodes of ``edges`` (src, dst).

    Each round is cut with ``checkpoint()``. It ends when a round changes nothing; the number of
    rounds grows with the logarithm of the components' size. No edges give an empty table.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    edges = edges.where("src <> dst").distinct().checkpoint()
    mark = None
    for _ in range(max_rounds):
        edges = _star(_star(edges, large=True), large=False).checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.hash("src", "dst").cast("long")), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.toDF("node", "root")
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
