"""Connected components of a graph given as edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut

SALTS = 1024
EDGES_AT_ONCE = 1 << 17


def _salted(edges: DataFrame) -> DataFrame:
    """For each node ``u`` the least neighbour. The second, redundant key makes Spark deal the result out again before a join on
    ``u``, directly below it, where adaptive execution can split a node with very many edges."""
    return edges.groupBy("u", F.pmod(F.xxhash64("u"), F.lit(SALTS))).agg(F.min("v").alias("least")).select("u", "least")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """One row per node that has an edge: node, component (its least node).

    ``edges`` has columns u and v of the same orderable type; direction, order and repetition do not matter, and rows with a
    null or with u = v are left out. Large-star and small-star steps alternate: in the one, every node tells its greater
    neighbours of the least; in the other, its lesser ones. The number of rounds grows with the logarithm of the longest
    path; each round is cut off in the shared folder. No node's neighbours are gathered in one place.
    """
    both = edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
    now = cut(both.where("u > v").distinct())
    for _ in range(most_rounds):
        if now.isEmpty():
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _salted(both).withColumn("least", F.least("u", "least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = cut(large.where("u <> v").distinct())
        least = _salted(large)
        small = large.join(least, "u")
        small = small.select("u", F.col("least").alias("v")).union(small.select(F.col("v").alias("u"), F.col("least").alias("v")))
        new = cut(small.where("u <> v").distinct())
        done = new.count() == now.count() and new.exceptAll(now).isEmpty()
        now = new
        if done:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct()
            )
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"components are not found after {most_rounds} rounds")


def components(edges: DataFrame) -> DataFrame:
    """``connected_components`` of edges (u, v) of longs; up to EDGES_AT_ONCE of them are joined on the driver, without rounds."""
    edges = cut(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    if edges.count() > EDGES_AT_ONCE:
        return connected_components(edges)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for u, v in zip(*(c.to_pylist() for c in edges.toArrow().select(["u", "v"]).columns), strict=True):
        u, v = sorted((root(u), root(v)))
        parent[v] = u
    table = {"node": pa.array(list(parent), pa.int64()), "component": pa.array([root(x) for x in parent], pa.int64())}
    return edges.sparkSession.createDataFrame(pa.table(table))
