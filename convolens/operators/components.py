"""Connected components over an edge table by alternating large and small stars.

Each half round replaces edges by edges to the smallest neighbour; neighbours are only reduced with min(), never
gathered, and every half round is written to the shared folder, so no node's degree has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard, settle


def _star(edges: DataFrame, name: str, large: bool) -> DataFrame:
    """Edges (u > v) after one star step: large links u's larger neighbours to u's minimum, small its smaller ones and u."""
    if large:
        seen = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = settle(seen.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")), f"{name}_low")
        out = edges.select(F.col("u").alias("big"), F.col("v").alias("u")).join(low, "u").select(F.col("big").alias("u"), F.col("low").alias("v"))
        out = out.unionByName(low.where("u > low").select("u", F.col("low").alias("v")))
    else:
        low = settle(edges.groupBy("u").agg(F.min("v").alias("low")), f"{name}_low")
        out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v")))
    out = settle(out.where("u > v").distinct(), name)
    discard(low, edges)
    return out


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v; any order, loops and repeats allowed); root is the
    smallest node reachable.  An empty table gives an empty result."""
    edges = settle(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    before = _signature(edges)
    for k in range(max_rounds if before[0] else 0):
        edges = _star(_star(edges, f"large{k}", True), f"small{k}", False)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
