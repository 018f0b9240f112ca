"""Connected components of a graph that is held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (child > parent): nodes are linked to their least neighbour.

    The large step moves the larger neighbours of a node, the small step the smaller ones.
    A hot node is reduced to one row before its neighbours join with it.
    """
    if large:
        edges = edges.union(edges.select(col("parent"), col("child")))
    least = edges.groupBy(col("child").alias("node")).agg(F.min("parent").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    moved = edges.join(least, col("child") == col("node"))
    other = col("parent") > col("child") if large else col("parent") != col("least")
    moved = moved.where(other).select(
        col("parent").alias("child"), col("least").alias("parent")
    )
    if not large:
        moved = moved.union(least.select(col("node").alias("child"), col("least").alias("parent")))
    return moved.where("child <> parent").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) that is not the root, the least node
    of its component.

    Alternating large and small star steps; rounds grow with the logarithm of the size, not with
    the diameter. Each round is a written table, so lost executors cost one round at most.
    """
    current = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        new_mark = current.agg(
            F.count("*"),
            F.expr("bit_xor(xxhash64(child, parent))"),
            F.sum(F.expr("child % 1000003")),
        ).first()
        if new_mark == mark or new_mark[0] == 0:
            return current.select(col("child").alias("node"), col("parent").alias("root"))
        mark = new_mark
        current = stored(_star(_star(current, large=True), large=False), "edges")
