"""Split and merge scoring of a segmentation against ground truth, plane by plane."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def scored_regions(vox: DataFrame, truth: str, seg: str, least: int = 10, epsilon: float = 0.4) -> DataFrame:
    """(z, gt, size, region, new_merge): each ground-truth region as good, merge, split, adjust or none.

    A region's overlaps are seen largest first (smaller segment id on ties) up to the first good one; its class is the
    first that applies of good, merge, split, adjust. new_merge marks the first region, by id, that claims a segment as a
    merge. Segment sizes leave out places without ground truth.
    """
    seen = vox.where(F.col(truth) > 0).select("z", F.col(truth).alias("gt"), F.col(seg).alias("seg"))
    ov = seen.groupBy("z", "gt", "seg").agg(F.count(F.lit(1)).alias("ov"))
    gt = ov.groupBy("z", "gt").agg(F.sum("ov").alias("size")).where(F.col("size") >= least)
    segs = ov.where("seg > 0").groupBy("z", "seg").agg(F.sum("ov").alias("seg_size")).where(F.col("seg_size") >= least)
    pairs = ov.join(gt, ["z", "gt"]).join(segs, ["z", "seg"])
    pairs = pairs.withColumn("mg", F.col("ov") / F.col("size") > 1 - epsilon).withColumn("ms", F.col("ov") / F.col("seg_size") > 1 - epsilon)
    order = W.partitionBy("z", "gt").orderBy(F.col("ov").desc(), "seg")
    before = F.sum((F.col("mg") & F.col("ms")).cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1))
    pairs = pairs.where(F.col("ov") > 0).withColumn("before", F.coalesce(before, F.lit(0))).where("before = 0")
    merge = F.col("mg") & ~F.col("ms")
    claim = F.min(F.when(merge, F.col("gt"))).over(W.partitionBy("z", "seg"))
    pairs = pairs.withColumn("claims", F.coalesce(merge & (claim == F.col("gt")), F.lit(False)))
    flags = pairs.groupBy("z", "gt").agg(
        F.max(F.col("mg") & F.col("ms")).alias("good"), F.max(merge).alias("merge"), F.max(~F.col("mg") & F.col("ms")).alias("split"),
        F.max(~F.col("mg") & ~F.col("ms")).alias("adjust"), F.max("claims").alias("claims"))
    region = F.when(F.col("good"), "good").when(F.col("merge"), "merge").when(F.col("split"), "split").when(F.col("adjust"), "adjust").otherwise("none")
    out = gt.join(flags, ["z", "gt"], "left").withColumn("region", region)
    return out.select("z", "gt", "size", "region", ((F.col("region") == "merge") & F.coalesce("claims", F.lit(False))).alias("new_merge"))


def summary(regions: DataFrame, *by: str) -> DataFrame:
    count = lambda name: F.count_if(F.col("region") == name).alias(f"n_{name}")
    return regions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_regions"), *map(count, ("good", "split", "merge", "adjust")), F.count_if("new_merge").alias("n_unique_merge"), F.sum("size").alias("area"), F.sum(F.when(F.col("region") == "good", F.col("size")).otherwise(0)).alias("good_area"))


def profiles(vox: DataFrame, label: str, least: int) -> DataFrame:
    """(z, label, area, new): the profiles of at least `least` pixels per plane, numbered from 1; smaller ones have new = 0."""
    sizes = vox.where(F.col(label) > 0).groupBy("z", F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("area"))
    kept = F.col("area") >= least
    rank = F.sum(kept.cast("int")).over(W.partitionBy("z").orderBy("label").rowsBetween(W.unboundedPreceding, 0))
    return sizes.withColumn("new", F.when(kept, rank).otherwise(0))
