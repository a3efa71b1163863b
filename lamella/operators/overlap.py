"""Areas, overlaps, exclusion sets and condensation of labels.

All are hash aggregations with a partial sum before the shuffle: what is shuffled is one row per distinct
label or pair and task, not voxels. Background (label 0) is filtered before joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def areas(vox: DataFrame, label: str, *by: str) -> DataFrame:
    return vox.where(F.col(label) > 0).groupBy(*by, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("area"))


def pair_counts(vox: DataFrame, first: str, second: str, *by: str) -> DataFrame:
    """(l1, l2, ov) of two labels of the same voxel, background left out."""
    both = vox.where((F.col(first) > 0) & (F.col(second) > 0))
    return both.groupBy(*by, F.col(first).alias("l1"), F.col(second).alias("l2")).agg(F.count(F.lit(1)).alias("ov"))


def aligned(a: DataFrame, b: DataFrame, first: str = "label", second: str = "label") -> DataFrame:
    """(l1, l2, ov) of two volumes joined at equal world coordinates."""
    left = a.where(F.col(first) > 0).select("z", "y", "x", F.col(first).alias("l1"))
    right = b.where(F.col(second) > 0).select("z", "y", "x", F.col(second).alias("l2"))
    return left.join(right, ["z", "y", "x"]).groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("ov"))


def links(segs: DataFrame, label: str, distance: int) -> DataFrame:
    """(dz, l1, l2, ov): labels at the same place dz = 1..distance planes apart."""
    own = segs.where(F.col(label) > 0).select("z", "y", "x", F.col(label).alias("l1"))
    ahead = segs.where(F.col(label) > 0).select(F.col("z").alias("zz"), "y", "x", F.col(label).alias("l2"))
    near = own.withColumn("dz", F.explode(F.sequence(F.lit(1), F.lit(distance)))).withColumn("zz", F.col("z") + F.col("dz"))
    return near.join(ahead, ["zz", "y", "x"]).groupBy("dz", "l1", "l2").agg(F.count(F.lit(1)).alias("ov"))


def exclusion_sets(segs: DataFrame, label: str = "label") -> DataFrame:
    """The distinct sets of two labels or more that candidates of a plane hold at a pixel, as sorted arrays."""
    at = segs.where(F.col(label) > 0).groupBy("z", "y", "x").agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return at.where(F.size("labels") > 1).select("z", "labels").distinct()


def condensed(cells: DataFrame, label: str = "label", cell: str = "cell") -> DataFrame:
    """(label, new): labels with equal sets of cells share the rank of the least of them.

    Sets are compared by their size and two sums of hashes, which add up before the shuffle, so no task holds a set.
    """
    shape = cells.distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.xxhash64(F.lit(seed), cell) % 1000000007).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2, 3)])
    least = shape.groupBy("n", "h1", "h2", "h3").agg(F.min(label).alias("kept"))
    return shape.join(least, ["n", "h1", "h2", "h3"]).select(label, "kept")


def numbered(df: DataFrame, order: list[str], out: str, start: int = 1) -> DataFrame:
    """df with `out` (long): consecutive numbers in the order of columns that tell its rows apart.

    A number is the place within a range-sorted part plus the sizes of the parts before, so no task sorts all rows.
    """
    from pyspark.sql import Window as W

    from ..session import written

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = written(df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "ranked")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return parts.join(before, "part").select(*df.columns, (F.col("before") + own + start).cast("long").alias(out))


def dense_ids(labels: DataFrame, column: str, start: int = 1) -> DataFrame:
    """(column, new): consecutive ids in ascending order of the distinct values."""
    return numbered(labels.select(column).distinct(), [column], "new", start)


def dominant(pairs: DataFrame, key: str, partner: str, weight: str) -> DataFrame:
    """(key, partner): the partner of largest weight, the least of them on ties."""
    best = F.max(F.struct(F.col(weight), (-F.col(partner)).alias("m")))
    return pairs.groupBy(key).agg(best.alias("best")).select(key, (-F.col("best.m")).alias(partner), F.col(f"best.{weight}").alias(weight))


def matches_theta(ov: Column, a1: Column, a2: Column, strict: bool = True, large: float = 20000, small: float = 2000, most: float = 0.9, both: float = 0.7) -> Column:
    """The threshold rule: a large overlap, or a medium one that covers enough of one side or both."""
    over = (lambda a, b: a > b) if strict else (lambda a, b: a >= b)
    covers = over(ov, most * a1) | over(ov, most * a2) | (over(ov, both * a1) & over(ov, both * a2))
    return over(ov, F.lit(large)) | (over(ov, F.lit(small)) & covers)


def boundary_stats(vox: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """(a, b, n, psum): faces between voxels of different labels, both ways; psum adds the probability of the voxel on a's side.

    Each voxel is sent to its three lower neighbours' places only; the symmetric half is the same rows, swapped.
    """
    own = vox.select("z", "y", "x", F.col(label).alias("a"), F.col(p).alias("pa"))
    steps = F.array(*[F.struct(*[F.lit(s).alias(c) for c, s in zip("zyx", step)]) for step in ((1, 0, 0), (0, 1, 0), (0, 0, 1))])
    moved = vox.withColumn("s", F.explode(steps)).select((F.col("z") - F.col("s.z")).alias("z"), (F.col("y") - F.col("s.y")).alias("y"), (F.col("x") - F.col("s.x")).alias("x"), F.col(label).alias("b"), F.col(p).alias("pb"))
    faces = own.join(moved, ["z", "y", "x"]).where("a <> b and a > 0 and b > 0")
    both = faces.select(F.explode(F.array(F.struct("a", "b", F.col("pa").alias("p")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("pb").alias("p")))).alias("f"))
    return both.groupBy("f.a", "f.b").agg(F.count(F.lit(1)).alias("n"), F.sum("f.p").alias("psum"))
