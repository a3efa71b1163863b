"""Volumes as relations of voxels: crops, block grids, halos, slabs and planes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def crop(vox: DataFrame, **box: tuple[int, int]) -> DataFrame:
    """Voxels with lo <= axis < hi for each named axis; reaches the scan as a pushed filter."""
    for axis, (low, high) in box.items():
        vox = vox.where((F.col(axis) >= low) & (F.col(axis) < high))
    return vox


def blocks_per_axis(size: int, core: int, halo: int) -> int:
    return (size - 2 * halo) // core


def block_grid(spark: SparkSession, size: tuple[int, int, int], core: tuple[int, int, int], halo: tuple[int, int, int]) -> DataFrame:
    """(bx, by, bz, block, lo and hi of each axis): boxes [i * core, i * core + core + 2 halo), ids x fastest."""
    n = [blocks_per_axis(s, c, h) for s, c, h in zip(size, core, halo)]
    i = F.col("id")
    grid = spark.range(n[0] * n[1] * n[2]).select(i.alias("block"), (i % n[0]).cast("int").alias("bx"), (F.floor(i / n[0]) % n[1]).cast("int").alias("by"), F.floor(i / (n[0] * n[1])).cast("int").alias("bz"))
    for axis, b, c, h in zip("xyz", ("bx", "by", "bz"), core, halo):
        grid = grid.withColumn(f"{axis}lo", F.col(b) * c).withColumn(f"{axis}hi", F.col(b) * c + c + 2 * h)
    return grid


def covering(position: Column, n: int, core: int, halo: int) -> Column:
    """The blocks of an axis whose box (with halo) holds a position, as an array."""
    low = F.greatest(F.lit(0), F.ceil((position - core - 2 * halo + 1) / core)).cast("int")
    high = F.least(F.lit(n - 1), F.floor(position / core)).cast("int")
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def diced(vox: DataFrame, size: dict[str, int], core: dict[str, int], halo: dict[str, int]) -> DataFrame:
    """Voxels repeated for every block that covers them (b<axis> for each axis): a narrow explode, no join."""
    for axis in size:
        n = blocks_per_axis(size[axis], core[axis], halo[axis])
        vox = vox.withColumn(f"b{axis}", F.explode(covering(F.col(axis), n, core[axis], halo[axis])))
    return vox


def halo_trimmed(vox: DataFrame, size: dict[str, int], core: dict[str, int], halo: dict[str, int]) -> DataFrame:
    """Diced voxels without the halos that face another block; the low one stays at 0, the high one at the end."""
    for axis in size:
        b, n = F.col(f"b{axis}"), blocks_per_axis(size[axis], core[axis], halo[axis])
        low = b * core[axis] + F.when(b > 0, halo[axis]).otherwise(0)
        high = b * core[axis] + core[axis] + 2 * halo[axis] - F.when(b < n - 1, halo[axis]).otherwise(0)
        vox = vox.where((F.col(axis) >= low) & (F.col(axis) < high))
    return vox


def dice_bounds(spark: SparkSession, full: int, core: int, halo: int) -> DataFrame:
    """(lo, hi) of cores along an axis: lo - halo clipped at 0, hi = min(full - 1, lo + core + 2 halo)."""
    start = F.col("id").cast("int")
    return spark.range(0, full, core).select(F.greatest(start - halo, F.lit(0)).alias("lo"), F.least(start - halo + core + 2 * halo, F.lit(full - 1)).alias("hi"))


def neighbour_pairs(grid: DataFrame) -> DataFrame:
    """(axis, parity, block1, block2) of blocks that follow each other along an axis; parity of the first's place."""
    a = grid.select("bx", "by", "bz", F.col("block").alias("block1"))
    out = None
    for axis in "xyz":
        moved = [(F.col(c) - 1).alias(c) if c == f"b{axis}" else F.col(c) for c in ("bx", "by", "bz")]
        pairs = a.join(grid.select(*moved, F.col("block").alias("block2")), ["bx", "by", "bz"]).select(F.lit(axis).alias("axis"), (F.col(f"b{axis}") % 2).alias("parity"), "block1", "block2")
        out = pairs if out is None else out.unionByName(pairs)
    return out


def plane_slab(z: Column, depth: int, last: int) -> tuple[Column, Column]:
    """(slab, offset) of a plane."""
    slab = F.least(F.floor(z / depth), F.lit(last)).cast("int")
    return slab, (z - slab * depth).cast("int")


def rotated(plane: DataFrame, rows: Column | int, columns: Column | int) -> DataFrame:
    """A plane turned by 90 degrees against the clock: (y, x) goes to (columns - 1 - x, y)."""
    others = [c for c in plane.columns if c not in ("x", "y")]
    return plane.select(*others, (F.lit(columns) - 1 - F.col("x")).cast("int").alias("y"), F.col("y").alias("x"))


def reassembled(tiles: DataFrame) -> DataFrame:
    """Pixels of overlapping tiles (tile, z, y, x, v): where several cover a place the last tile's stands."""
    return tiles.groupBy("z", "y", "x").agg(F.max_by("v", "tile").alias("v"))
