"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one they share.

    ``edges`` has ``u > v``.  A large star links every larger neighbour of a
    node to the smallest node around it; a small star does so with the smaller
    neighbours and the node itself.  The smallest neighbour is a map-side
    combined aggregate, written once, so that both sides of the join are plain
    shuffles, which adaptive execution splits where a node has many edges.
    """
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = stable(sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    if large:
        sides = sides.where("v > u")
    out = sides.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` that has another one beside it.

    The component is named by its smallest node.  Direction, repeats, loops and
    edges with a null end do not matter.  The number of rounds grows with the
    logarithm of the longest path; each writes its edges, at most as many as at
    the start, below the checkpoint folder.
    """
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now, before = stable(now.distinct()), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        now = stable(_star(stable(_star(now, large=True)), large=False))
