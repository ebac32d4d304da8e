"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import materialize


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """One round: every node's neighbours (large star: the greater ones) move to its smallest neighbour."""
    if both:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = near.join(low, "a")
    if both:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node with an edge in (a, b); the component is its smallest node.

    Rounds grow with the logarithm of the longest path; each is written to the
    shared folder. A node with very many neighbours is combined map-side for
    its minimum and split by the adaptive plan in the join.
    """
    now = materialize(edges.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct(), name)
    before = None
    state = _state(now)
    while state[0] and state != before:
        before = state
        now = materialize(_stars(_stars(now, True), False), name)
        state = _state(now)
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
