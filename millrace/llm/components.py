"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import discard, materialise


def _hang_on_least(edges: DataFrame, far: bool) -> DataFrame:
    """Replace the edges of every node by edges to its least neighbour.

    ``far`` keeps the neighbours above the node (a large star), otherwise those below it (a small star).
    The minimum is a partial aggregation and the way back is an inner join, so a node that a third of
    all links touch is split by the skew-join rule.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not far:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    hung = both.join(least, "u")
    if far:
        return hung.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct()
    moved = hung.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()


def component_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`components`, and the written table that it reads, to be discarded by the caller after use."""
    edges = materialise(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        if not now[0]:
            break
        after = materialise(_hang_on_least(_hang_on_least(edges, True), False), "edges")
        discard(edges)
        edges = after
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    )
    return labels.distinct(), edges


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node that an edge ``(u, v)`` touches, label being the least node of its component.

    Self links and repeated links change nothing; an empty table gives an empty table. Each round is
    written to the shared folder, and the rounds end when the edge set is a fixed point.
    """
    return component_edges(edges)[0]
