"""Connected components of an undirected graph that is held as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Workspace


def components(edges: DataFrame, work: Workspace, rows: int | None = None) -> DataFrame:
    """`edges(a, b)` to `(node, component)`, component being the smallest node that can be reached. `rows`: edges, about.

    Each round takes the smallest label among the neighbours and then the label of that label (pointer jumping),
    so chains shorten by more than half a round. Only a count of changed labels reaches the driver."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    rows = None if rows is None else 2 * rows
    both = work.keep(both, "links", rows)
    labels = work.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels", rows
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        step = work.keep(step, "step", rows)
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = step.join(jump, "component", "left").select("node", "old", F.coalesce("further", "component").alias("component"))
        after = work.keep(after, "labels", rows)
        work.drop(step)
        changed = after.filter("old <> component").count()
        work.drop(labels)
        labels = after.drop("old")
        labels._sylvan_path = after._sylvan_path
        if not changed:
            work.drop(both)
            return labels
