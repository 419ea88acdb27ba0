"""Connected components of undirected edges over nodes of any type that has an order (structs included)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.session import written


def unsent(df: DataFrame) -> DataFrame:
    """`df` as a join side that is never sent through the driver: compressed files look small beside the rows they hold."""
    return df.hint("merge")


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for all ends of `edges` (a, b); a component is named by its smallest node.

    Each round every node that has a smaller neighbour hooks onto its smallest one, chains of hooks are shortened by jumping to the hook's
    hook until they end at a root, and the edges are drawn anew between roots. Only nodes that are smallest among their
    neighbours are left, so the edges shrink quickly whatever the shape, long paths included. Every step is written, so plans stay short.
    """
    left = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    labels = written(ends.withColumn("component", F.col("node")), "labels")
    for _ in range(max_rounds):
        if left.limit(1).count() == 0:
            return labels
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root"))
        hooks = _shortened(written(hooks, "hooks"), max_rounds)
        labels = written(_moved(labels, hooks, "component"), "labels")
        left = written(_moved(_moved(left, hooks, "a"), hooks, "b").where("a <> b").distinct(), "edges")
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def _shortened(hooks: DataFrame, max_rounds: int) -> DataFrame:
    """Every node's hook replaced by the root its chain ends at."""
    for _ in range(max_rounds):
        further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        # A root hooks onto itself, so every hook is found.
        new = written(hooks.join(unsent(further), "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "hooks")
        hooks = new.select("node", "root")
        if new.where("moved").limit(1).count() == 0:
            return hooks
    raise RuntimeError(f"hooks not settled after {max_rounds} rounds")


def _moved(df: DataFrame, hooks: DataFrame, col: str) -> DataFrame:
    """`df` with `col` replaced by its root where it has one."""
    to = hooks.select(F.col("node").alias(col), F.col("root").alias("_root"))
    return df.join(unsent(to), col, "left").select(*[F.coalesce("_root", col).alias(col) if c == col else c for c in df.columns])
