"""Connected components of an edge table as DataFrame contraction rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import staged


def _follow(labels: DataFrame, pointers: DataFrame) -> DataFrame:
    """Labels replaced by what they point to."""
    on = pointers.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return labels.join(on, "label", "left").select("node", F.coalesce("next", "label").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b); label is the least node of its component.

    Each round every node points to its least neighbour, pointers are shortened
    twice, and the edges are contracted to the nodes pointed to; rounds end when
    no edge joins two nodes. Nulls and self-loops are ignored. Every round is
    written to the shared folder, so nothing is recomputed when executors go.
    """
    spark = edges.sparkSession
    found = None
    left = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), "pointers")
        up = staged(_follow(_follow(up, up), up), "pointers")
        found = up if found is None else staged(_follow(found, up), "labels")
        pa = up.select(F.col("node").alias("a"), F.col("label").alias("pa"))
        pb = up.select(F.col("node").alias("b"), F.col("label").alias("pb"))
        left = staged(left.join(pa, "a").join(pb, "b").where("pa <> pb")
                      .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
    if found is None:
        kind = edges.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, label {kind}")
    return found
