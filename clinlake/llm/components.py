"""Connected components of a table of edges, by alternating large-star and small-star rounds.

Every round rewires each node to the smallest node around it, so that the
edges become stars around the components' smallest nodes in a number of rounds
that is logarithmic in practice.  A node's neighbours are never gathered: the
smallest one is a partially aggregated minimum, and in the join back every
node's edges are dealt out over ``SALTS`` parts, each of which meets a copy of
the node's minimum, so the edges of a hub never meet in one task.
Each round is written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import cut


SALTS = 8


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (a, b) with the minimum ``m`` of their node ``a``."""
    copies = least.select("a", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).join(copies, ["a", "salt"]).drop("salt")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())  # two numbers


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _with_least(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(down, least).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the edges (a, b), which may repeat or be loops."""
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges).distinct()).distinct())
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
