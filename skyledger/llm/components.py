"""Connected components by contraction, over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, release


def _to_labels(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges between nodes of different labels, as edges between these labels."""
    for c in "ab":
        edges = edges.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c)
    return edges.filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """node, label (one node of its component, the same for the whole component) of every node of ``edges`` (a, b). No edges: no rows.

    Each node takes the neighbour of the least hash, or itself, as its label. Edges inside a label are done with; the others are
    edges between labels, of which the components are looked for in the same way. So a star takes one pass, and as hashes are in
    no order along a path, a pass leaves about half of its nodes at most.
    """
    edges = edges.select("a", "b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("_near"))
    own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("b"))
    labels = materialize(ranked.select("node", F.least(own, F.col("_near"))["b"].alias("label")), "components-labels")
    rest = materialize(_to_labels(edges, labels), "components-edges")
    if not rest.isEmpty():
        further = components(rest)
        near, far = labels, further.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        labels = materialize(near.join(far, "label", "left").select("node", F.coalesce("_far", "label").alias("label")), "components-labels")
        release(near)
        release(further)
    release(rest)
    return labels
