"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is two aggregates with partial sums and two joins by node, so a hub of any degree is never held in one
task. The steps needed grow with the logarithm of the longest chain; each is stored to cut lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of one orderable type -> (node, root): the least node reachable from each.

    Loops, repeated edges and edges with a null end are left out; nodes without an edge don't appear.
    """
    state = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state, before = stored(state, "edges"), None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        state = stored(_small_star(_large_star(state).distinct()).distinct(), "edges")
    root = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.union(root.select(F.col("root").alias("node"), "root").distinct())
