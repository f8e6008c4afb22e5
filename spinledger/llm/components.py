"""Components of a growing set of links, in Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """(node, component) after further links (a, b); a node without a row is its own component.

    Component numbers are the smallest node of each. Every component that a link joins to
    a smaller one hooks onto the smallest such, the hooks are followed to their ends, and
    links that still join two components go round again: each round at least halves the
    components that have links left. A link is small, and hot components are split by
    partial aggregation and adaptive execution.
    """
    while True:
        left = stored(_between(labels, edges), "links")
        if left.isEmpty():
            return labels
        hooks = _followed(left.groupBy("a").agg(F.min("b").alias("b")))
        moved = hooks.select(F.col("a").alias("node"), F.col("b").alias("component"))
        if labels is not None:
            changed = labels.join(hooks.select(F.col("a").alias("component"), F.col("b").alias("to")), "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
            moved = changed.unionByName(moved.join(labels, "node", "left_anti"))
        labels, edges = stored(moved, "labels"), left


def labelled(frame: DataFrame, labels: DataFrame | None, node: str, component: str) -> DataFrame:
    """``frame`` with the component of a node column."""
    if labels is None:
        return frame.withColumn(component, F.col(node))
    own = labels.select(F.col("node").alias(node), F.col("component").alias(component))
    return frame.join(own, node, "left").withColumn(component, F.coalesce(component, node))


def _between(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(larger, smaller) components that links still join."""
    both = labelled(labelled(edges.select("a", "b"), labels, "a", "ca"), labels, "b", "cb")
    return both.where("ca <> cb").select(F.greatest("ca", "cb").alias("a"), F.least("ca", "cb").alias("b")).distinct()


def _followed(hooks: DataFrame) -> DataFrame:
    """Hooks (a, b) with b < a, each replaced by the end of its chain; doubles the step each time."""
    hooks = stored(hooks, "hooks")
    while True:
        further = hooks.select(F.col("a").alias("b"), F.col("b").alias("c"))
        if hooks.join(further, "b", "left_semi").isEmpty():
            return hooks
        hooks = stored(hooks.join(further, "b", "left").select("a", F.coalesce("c", "b").alias("b")), "hooks")
