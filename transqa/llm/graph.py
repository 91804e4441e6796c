"""Connected components of an edge table, by alternating large and small stars.

Every round is joins and aggregates of fixed size per node, so a node with very many
neighbours is combined on the map side and never gathered. A round's edges are
written to the shared folder; what the driver sees of them is a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transqa.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label each node of ``edges`` with the smallest node it can reach.

    Returns (id, component) for nodes that have an edge to another node. Edges with a
    null end and edges from a node to itself are ignored; repeats do no harm. An
    empty table gives an empty result.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("whole"))
        .where("whole AND u <> v").select("u", "v").distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).union(
        now.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()
