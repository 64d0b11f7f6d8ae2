"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import forget, stored
from fieldweave.operators.joins import split_join


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node are tied to the smallest of them and the node."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    ends = edges.unionByName(back)
    if not large:
        ends = ends.filter("v < u")
    smallest = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = split_join(ends, smallest, ["u"], "inner")
    if large:
        tied = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
    return tied.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none."""
    rows, nodes = edges.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
    inner = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_semi")
    return rows == nodes and inner.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: every node ``u`` of ``edges (u, v)`` that is not the smallest of its component, with the smallest, ``v``.

    Alternating large-star and small-star steps, until the edges are stars. Each step is written to the shared folder,
    so lineage stays short, and its predecessor is deleted. The number of steps grows with the logarithm of the largest
    component.
    """
    state = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(state):
        for large in (True, False):
            following = stored(_star(state, large))
            forget(state)
            state = following
    return state
