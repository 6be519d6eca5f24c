"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 64) -> DataFrame:
    """``(node, component)`` of every node that has an edge; a component's name is its smallest node.

    Each round replaces the edges by stars around smaller nodes (two grouped
    minima and two equi joins, aggregated before the shuffle) and is cut through
    the checkpoint folder; a hub's rows are split by the skew join. Edges with a
    null end and loops are left out. The rounds needed grow with the logarithm of
    the longest path; running out of ``max_rounds`` raises.
    """
    edges = (
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .distinct()
    )
    edges = cut(edges)
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        after = cut(_small_star(_large_star(edges)))
        now = _state(after)
        edges = after
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
