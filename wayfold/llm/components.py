"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and itself.

    The large star moves a node's larger neighbours, the small star the smaller ones and the node.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else both.filter("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = (both.filter("b > a") if large else around).join(least, "a")
    links = moved.select(F.col("b").alias("x"), "low")
    if not large:
        links = links.union(least.select(F.col("a").alias("x"), "low"))
    return links.filter("x <> low").select(F.col("x").alias("a"), F.col("low").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): each node of an edge (a, b) with the smallest node it is connected to.

    Nulls and loops in the edges are ignored; an empty table gives an empty one. Every round is written
    to the shared folder; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = edges.filter("a is not null and b is not null and a <> b").select("a", "b").distinct()
    state = written(edges, name)
    before = None
    while True:
        state = written(_star(_star(state, large=True), large=False), name)
        # Order-free fingerprint of the edges; unchanged once every component is a star.
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
