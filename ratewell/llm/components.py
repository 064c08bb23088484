"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (map-side partial) and a join of the edges with
that small table, which is written first, so that a node with very many edges
is split among tasks.  Each step's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`id` and `component` (the smallest id reachable) of all ids on an edge (u, v).

    Null ends and loops are ignored, repeated edges count once, an empty table
    gives an empty result.  The number of rounds grows with the logarithm of the
    longest chain, and the edges never grow in number.
    """
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = written(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "least")
        large = written(both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        pulled = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(pulled.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        state, before = _state(e), state
        if state == before:
            break
    ids = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
