"""Connected components of an undirected edge DataFrame (D3).

Alternating large-star / small-star rounds (Kiveris et al., SoCC 2014) until
the edges form a star forest; each node then points at the smallest node id
of its component.  Every round is aggregation + join on the node id (AQE
splits a hub node's skewed partition) and the edge set is written to the
shared checkpoint folder between rounds, so lineage stays short and a lost
executor costs one round at most.  Convergence (a star forest) is tested
directly; the driver only learns whether any offending edge exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.session import cut_lineage


def _undirected(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(e: DataFrame) -> DataFrame:
    n = _undirected(e).distinct()
    m = n.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (n.join(m, "u").filter(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    d = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
         .filter(F.col("u") != F.col("v")).distinct()
    m = d.groupBy("u").agg(F.min("v").alias("m"))
    moved = d.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(m.select("u", F.col("m").alias("v"))) \
                .filter(F.col("u") != F.col("v")).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """Converged: every edge points at a smaller node, each node has one
    edge, and no edge target is itself a source (so targets are roots)."""
    bad = e.filter(F.col("v") >= F.col("u")).select("u") \
           .unionByName(e.groupBy("u").count().filter(F.col("count") > 1).select("u")) \
           .unionByName(e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u"))
    return bad.isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 200) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component = min node id."""
    e = cut_lineage(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
                    .filter(F.col("u") != F.col("v")), "cc-edges")
    for _ in range(max_rounds):
        if _is_star_forest(e):
            break
        e = cut_lineage(_small_star(_large_star(e)), "cc-edges")
    else:
        raise RuntimeError("connected components did not converge")
    # converged: every edge is (node, root) with root < node
    nodes = _undirected(e).select(F.col("u").alias("node"), F.col("v").alias("x"))
    return nodes.groupBy("node").agg(F.least(F.min("x"), F.col("node")).alias("component"))
