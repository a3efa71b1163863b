"""Clean-up of a block's labels: small segments, single neighbours, skips and branches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .overlap import boundary_stats, dominant


def agglomerated(stats: DataFrame, sizes: DataFrame, least: int, by: str = "block") -> DataFrame:
    """(by, label, target): segments under `least` voxels joined to the neighbour of the lowest mean boundary probability.

    stats(by, a, b, n, psum) is symmetric; sizes(by, label, area). Segments are taken by their first size (then id); sizes
    and boundaries grow with every join, so a block's joins run in sequence in one task: a group is the region graph of
    one block, whose size the block bounds. Ties go to the smaller neighbour.
    """

    def run(key, stats: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        area = dict(zip(sizes["label"], sizes["area"]))
        near: dict[int, dict[int, list[float]]] = {v: {} for v in area}
        for a, b, n, p in zip(stats["a"], stats["b"], stats["n"], stats["psum"]):
            near[a][b] = [n, p]
        parent = {v: v for v in area}
        for v in [v for v, s in sorted(area.items(), key=lambda t: (t[1], t[0])) if s < least]:
            if parent[v] != v or area[v] >= least or not near[v]:
                continue
            to = min(near[v], key=lambda u: (near[v][u][1] / near[v][u][0], u))
            parent[v] = to
            area[to] += area[v]
            for u, (n, p) in near.pop(v).items():
                near[u].pop(v, None)
                if u != to:
                    for one, other in ((to, u), (u, to)):
                        old = near[one].setdefault(other, [0, 0.0])
                        old[0] += n
                        old[1] += p

        def top(v):
            while parent[v] != v:
                v = parent[v]
            return v

        labels = sorted(parent)
        return pd.DataFrame({by: key[0], "label": labels, "target": [top(v) for v in labels]})

    return stats.groupBy(by).cogroup(sizes.groupBy(by)).applyInPandas(run, f"{by} long, label long, target long")


def singly_connected(vox: DataFrame, label: str = "label") -> DataFrame:
    """(label, target): labels with one neighbour that do not touch a wall of the block, and that neighbour."""
    stats = boundary_stats(vox, label)
    one = stats.groupBy(F.col("a").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("target")).where("n = 1")
    box = vox.agg(*[f(c).alias(f"{c}{i}") for c in "zyx" for i, f in enumerate((F.min, F.max))])
    wall = vox.join(F.broadcast(box)).where(" or ".join(f"{c} = {c}0 or {c} = {c}1" for c in "zyx")).select(F.col(label).alias("label")).distinct()
    return one.join(wall, "label", "left_anti").select("label", "target")


def skip_repairs(vox: DataFrame, distance: int, label: str = "label") -> DataFrame:
    """(z, y, x, label): voxels to stamp where a label is present at z and z + k but absent at z + 1 (k = 2 .. distance)."""
    last = vox.agg(F.max("z")).first()[0] or 0
    own = vox.where(F.col(label) > 0).select("z", "y", "x", F.col(label).alias("label"))
    present = own.select("z", "label").distinct()
    missing = present.where(F.col("z") <= last - distance).join(present.select((F.col("z") - 1).alias("z"), "label"), ["z", "label"], "left_anti")
    begin = own.join(missing, ["z", "label"]).withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(distance)))).withColumn("zz", F.col("z") + F.col("k"))
    meet = begin.join(own.withColumnRenamed("z", "zz"), ["zz", "y", "x", "label"])
    return meet.select(F.explode(F.expr("sequence(z + 1, zz - 1)")).alias("z"), "y", "x", "label").distinct()


def branch_repairs(vox: DataFrame, label: str = "label", least_overlap: float = 0.9, least_area: float = 0.005) -> DataFrame:
    """(z, to_z, label, target): labels absent in a neighbouring plane that lie on one partner there."""
    own = vox.select("z", "y", "x", F.col(label).alias("label"))
    plane = own.groupBy("z").agg(F.count(F.lit(1)).alias("plane"))
    area = own.where("label > 0").groupBy("z", "label").agg(F.count(F.lit(1)).alias("area"))
    out = None
    for step in (1, -1):
        there = area.select((F.col("z") - step).alias("z"), "label")
        planes = plane.select((F.col("z") - step).alias("z"))
        missing = area.join(planes, "z", "left_semi").join(there, ["z", "label"], "left_anti").join(plane, "z").where(F.col("area") / F.col("plane") >= least_area)
        other = own.select((F.col("z") - step).alias("z"), "y", "x", F.col("label").alias("partner"))
        ov = own.join(missing, ["z", "label"]).join(other, ["z", "y", "x"]).groupBy("z", "label", "area", "partner").agg(F.count(F.lit(1)).alias("ov"))
        best = dominant(ov.withColumn("k", F.struct("z", "label", "area")), "k", "partner", "ov")
        best = best.where(F.col("ov") / F.col("k.area") >= least_overlap).select(F.col("k.z").alias("z"), (F.col("k.z") + step).alias("to_z"), F.col("k.label").alias("label"), F.col("partner").alias("target"))
        out = best if out is None else out.unionByName(best)
    return out
