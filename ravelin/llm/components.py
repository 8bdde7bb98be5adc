"""Connected components by alternating large-star and small-star.

Each round writes its edges to the shared folder, so lineage stays short, and deletes the round
before. Stars are made by a partial-aggregated minimum and a join, not in one group, so a hub with
a large part of all edges is split like any skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import discard, materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of its closed neighbourhood."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), "m")
    return linked.union(least).select("u", F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v); the component is its least node.

    Self-links and repeated links change nothing; rows with a null are not links; no edges give
    no rows.
    """
    clean = edges.select("u", "v").where(F.col("u") != F.col("v")).distinct()
    now = materialize(clean, "edges")
    state = _state(now)
    while state[0]:
        ahead = materialize(small_star(large_star(now)), "edges")
        discard(now)
        now, was, state = ahead, state, _state(ahead)
        if state == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
