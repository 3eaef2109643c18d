"""Connected components by repeated contraction, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.llm.common import staged


def _map(df: DataFrame, column: str, step: DataFrame) -> DataFrame:
    """Replace ``column`` by what ``step`` (node, to) has for it; others stay."""
    names = [F.coalesce("_to", column).alias(c) if c == column else F.col(c) for c in df.columns]
    other = step.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    return df.join(other, df[column] == F.col("_node"), "left").select(*names)


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Each round hooks every node to its smallest smaller neighbour, follows these
    hooks four steps and contracts the edges accordingly, until no edge is left.
    The smallest node of a component never moves, so it ends as the label.  Hubs
    are met by partial aggregates and by joins of plain scans, which adaptive
    execution splits.  Edges with a null end and loops are ignored; nodes without
    an edge are not listed.
    """
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), F.col(a).isNotNull().alias("_a"), F.col(b).isNotNull().alias("_b"))
    first = links = staged(pairs.where("_a and _b and u < v").select("u", "v").distinct(), "links")
    steps = []
    while not links.isEmpty():
        hooks = staged(links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("to")), "hooks")
        jumped = staged(_map(_map(hooks, "to", hooks), "to", hooks), "jumped")
        moved = _map(_map(links, "u", jumped), "v", jumped)
        again = moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        steps.append(jumped)
        links = staged(again.distinct(), "links")
    nodes = first.select(F.col("u").alias("node")).union(first.select("v")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    for step in steps:
        labels = _map(labels, "component", step)
    return labels
