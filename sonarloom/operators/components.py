"""Connected components of a distributed edge table by hooking and pointer jumping.

In each step every component root hooks onto the smallest root it has an edge to (a partial aggregate, so a node
with very many edges is no hot spot), chains of hooks are shortened by pointer jumping, and edges are contracted to
roots. The number of components halves at least, so steps grow with the logarithm of the input; star-shaped groups
take one. Intermediate tables are written to the shared folder, which cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonarloom import workspace


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) of every node that has an edge to another one.

    Edges have no direction; loops, repeated edges and nulls are ignored; an empty table gives an empty result."""
    left = _contracted(edges.select(F.col(a).alias("x"), F.col(b).alias("y")))
    left = workspace.materialize(left, "edges")
    labels = None
    while not left.isEmpty():
        hooks = workspace.materialize(_jumped(left.groupBy("x").agg(F.min("y").alias("up"))), "hooks")
        # Roots that hook no further stand for themselves.
        if labels is None:
            labels = hooks.select(F.col("x").alias("node"), F.col("up").alias("root"))
        else:
            moved = labels.join(hooks, F.col("root") == F.col("x"), "left").select("node", F.coalesce("up", "root").alias("root"))
            labels = moved.union(hooks.select("x", "up"))
        labels = workspace.materialize(labels, "labels")
        up, side = hooks.select(F.col("x").alias("hx"), F.col("up").alias("hu")), hooks.select(F.col("x").alias("kx"), F.col("up").alias("ku"))
        moved = left.join(up, F.col("x") == F.col("hx"), "left").join(side, F.col("y") == F.col("kx"), "left")
        left = workspace.materialize(_contracted(moved.select(F.coalesce("hu", "x").alias("x"), F.coalesce("ku", "y").alias("y"))), "edges")
    if labels is None:
        return left.select(F.col("x").alias("node"), F.col("y").alias("root"))
    # A node that hooked in one step and whose root hooked later can stand twice; roots stand for themselves.
    labels = labels.groupBy("node").agg(F.min("root").alias("root"))
    return workspace.materialize(labels.union(labels.select(F.col("root").alias("node"), "root").distinct()), "components")


def _contracted(edges: DataFrame) -> DataFrame:
    """Larger end, smaller end; without loops, nulls and repeats."""
    return edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"), (F.col("x") != F.col("y")).alias("ok")).where("ok").select("x", "y").distinct()


def _jumped(hooks: DataFrame) -> DataFrame:
    """Each hook to the end of its chain: every hook goes to a smaller node, so chains end."""
    while True:
        hooks = workspace.materialize(hooks, "jumps")
        again = hooks.select(F.col("x").alias("via"), F.col("up").alias("beyond"))
        longer = hooks.join(again, F.col("up") == F.col("via"), "left")
        if longer.where(F.col("beyond").isNotNull()).isEmpty():
            return hooks
        hooks = longer.select("x", F.coalesce("beyond", "up").alias("up"))
