"""Connected components of a large edge list by alternating large-star and small-star steps.

Each step regroups the edges under a smaller neighbour and is one shuffle with a hash aggregate, so a
vertex with very many edges is combined before it is shuffled and never gathered as a list. Steps
are written to the shared folder, which cuts the plan and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _stars(edges: DataFrame, *, large: bool) -> DataFrame:
    """Join each vertex's neighbours (the larger ones, or the smaller ones with itself) to the least of all."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "a").select("b", "m").filter("b <> m").toDF("a", "b").unionByName(least.toDF("a", "b"))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame, most_steps: int = 60) -> DataFrame:
    """``(vertex, component)`` of every vertex with an edge to another one; the least vertex names the component.

    ``edges`` has two comparable columns. Loops, repeats, either direction and nulls (which link
    nothing) are allowed. The number of steps grows with the logarithm of the size of a component.
    """
    names = edges.columns
    edges = edges.select(F.col(names[0]).alias("a"), F.col(names[1]).alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "edges")
    before = None
    for _ in range(most_steps):
        edges = materialize(_stars(edges, large=True), "large-star")
        edges = materialize(_stars(edges, large=False), "small-star")
        # Edges are now (vertex, smaller vertex); they are final once a full round changes none of them.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_steps} rounds")
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
