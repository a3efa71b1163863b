"""Connected components by alternating large-star and small-star, as DataFrame joins.

Each round is written to the shared folder, so lineage stays short and a lost executor costs one round.
Per node only a minimum is aggregated (with map-side partial sums), so a hub of any degree never meets in
one task; the join that hands a hub's minimum to its edges is one that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """edges, stored, and its number of rows and checksum, gathered while writing."""
    seen = Observation()
    out = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
    return out, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(u, v) -> (node, component), component being the least node reachable.

    Only nodes with an edge to another node are returned; nulls and loops are ignored; no edges give no rows.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, seen = _counted(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges, now = _counted(_small_star(_large_star(edges)).where("u <> v").distinct())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    stars = edges.groupBy("v").agg(F.count(F.lit(1))).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars)
