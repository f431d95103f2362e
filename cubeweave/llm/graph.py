"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.llm.tables import save


def _point(edges: DataFrame, keep) -> DataFrame:
    """Link the neighbours that ``keep`` chooses, and the node, to the node's least neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u").where(keep).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """The component of each node that occurs in ``links``.

    links: a, b (64-bit numbers, one row for a link at least, in any order).
    Returns node, label: label is the least node of the component. Every round
    is two joins of the links with one row for each node; the number of rounds
    grows with the logarithm of the longest path. Nothing is gathered: a node
    with very many links is a skewed join key, which adaptive execution splits.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen = save(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _point(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _point(large.where("u > v").distinct(), F.lit(True))
        edges = save(
            small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u > v").distinct(),
            "edges",
        )
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        seen = state
