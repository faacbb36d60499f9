"""Connected components of an edge table: every node hangs itself on its least neighbour, trees shrink to their roots, and the edges
that are left go on between the roots; nothing comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored, stored_with


def hung(links: DataFrame) -> DataFrame:
    """(node, component) of all v of links (u, v) with u < v in which each v has one u: every node looks up its parent's parent
    until all hang on their root. Roots have no row."""
    steps = stored(links.select(F.col("v").alias("node"), F.col("u").alias("component")), "trees")
    while True:
        above = steps.select(F.col("node").alias("component"), F.col("component").alias("above"))
        moved = steps.select("node", "component").join(above, "component", "left")
        moved = moved.select("node", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved"))
        steps, seen = stored_with(moved, "trees", F.count_if("moved").alias("moved"))
        if not seen["moved"]:
            return steps.select("node", "component")


def _with_roots(hanging: DataFrame) -> DataFrame:
    return hanging.union(hanging.select(F.col("component").alias("node"), "component").distinct())


def trees(links: DataFrame) -> DataFrame:
    """``hung`` with a row for each root, too."""
    return _with_roots(hung(links))


def contracted(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (u, v) that are not the least of their component.

    Each turn at least halves the nodes that still have an edge: each of them hangs itself on a lesser one, or a greater one
    hangs itself on it. A node with very many edges is pre-aggregated. Where few edges are left, a turn is one shuffle.
    """
    edges = stored(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where(F.col("u") != F.col("v")), "edges")
    found = None
    while True:
        turn = hung(edges.groupBy("v").agg(F.min("u").alias("u")))
        for end in ("u", "v"):
            edges = edges.join(turn.select(F.col("node").alias(end), F.col("component").alias(f"{end}_root")), end, "left")
        roots = [F.coalesce(f"{end}_root", end) for end in ("u", "v")]
        edges = edges.select(F.least(*roots).alias("u"), F.greatest(*roots).alias("v")).where(F.col("u") != F.col("v"))
        edges, seen = stored_with(edges, "edges")
        if found is not None:
            above = turn.select(F.col("node").alias("component"), F.col("component").alias("above"))
            moved = found.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
            # What hangs itself now was a root before.
            turn = stored(moved.union(turn), "found")
        found = turn
        if not seen["rows"]:
            return found


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (u, v); the component is its least node. Loops and repeats are harmless."""
    return _with_roots(contracted(edges))
