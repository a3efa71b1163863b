"""Neighbourhood operators on image rows (y, x, v), each plane for itself: `by` names the columns that tell planes apart.

Separable filters run as two windows, one along each axis; each needs a shuffle by the other axis. Values
beyond the border repeat as `reflect-101` (the border itself is not repeated) or count as zero, as stated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

Planes = tuple[str, ...]


def along(axis: str, by: Planes = ()):
    """The window over a line of a plane along an axis."""
    return W.partitionBy(*by, "y" if axis == "x" else "x").orderBy(axis)


def shifted(image: DataFrame, dy: int, dx: int, out: str, fill: float = 0.0, by: Planes = ()) -> DataFrame:
    """image with `out`, the value at (y - dy, x - dx), `fill` beyond the border."""
    if dx and dy:
        return _diagonal(image, dy, dx, out, fill, by)
    w = along("x" if dx else "y", by)
    step = dx or dy
    return image.withColumn(out, (F.lag if step > 0 else F.lead)("v", abs(step), fill).over(w))


def _diagonal(image: DataFrame, dy: int, dx: int, out: str, fill: float, by: Planes) -> DataFrame:
    moved = image.select(*by, (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), F.col("v").alias(out))
    return image.join(moved, [*by, "y", "x"], "left").withColumn(out, F.coalesce(out, F.lit(fill)))


def gradient(axis_window: W, v: str = "v") -> Column:
    """Central differences, one-sided at the ends."""
    back, ahead = F.lag(v).over(axis_window), F.lead(v).over(axis_window)
    return F.when(back.isNull() & ahead.isNull(), F.lit(0.0)).when(back.isNull(), ahead - F.col(v)).when(ahead.isNull(), F.col(v) - back).otherwise((ahead - back) / 2)


def kernel(sigma: float, radius: int) -> list[float]:
    k = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [x / sum(k) for x in k]


def convolved(image: DataFrame, weights: list[float], axis: str, v: str = "v", out: str = "v", by: Planes = ()) -> DataFrame:
    """A symmetric filter along an axis, reflect-101 at the borders. The line must be longer than the radius."""
    radius = len(weights) // 2
    other = "x" if axis == "y" else "y"
    w = along(axis, by)
    place, last = F.row_number().over(w) - 1, F.count(F.lit(1)).over(W.partitionBy(*by, other)) - 1
    line = F.collect_list(v).over(w.rowsBetween(-2 * radius, 2 * radius))
    image = image.withColumn("_i", place).withColumn("_n", last).withColumn("_line", line).withColumn("_at", F.least(F.col("_i"), F.lit(2 * radius)))
    total = F.lit(0.0)
    for k, weight in zip(range(-radius, radius + 1), weights):
        j = F.col("_i") + k
        j = F.when(j < 0, -j).when(j > F.col("_n"), 2 * F.col("_n") - j).otherwise(j)
        total = total + weight * F.get("_line", (j - F.col("_i") + F.col("_at")).cast("int"))
    return image.withColumn(out, total).drop("_i", "_n", "_line", "_at")


def blurred(image: DataFrame, sigma: float, radius: int, v: str = "v", out: str = "v", by: Planes = ()) -> DataFrame:
    k = kernel(sigma, radius)
    return convolved(convolved(image, k, "x", v, out, by), k, "y", out, out, by)


def local_variance(image: DataFrame, sigma: float, radius: int, by: Planes = ()) -> DataFrame:
    """mean and var, Gaussian-weighted: blur(v * v) - blur(v) ** 2."""
    both = blurred(blurred(image.withColumn("_q", F.col("v") * F.col("v")), sigma, radius, "v", "mean", by), sigma, radius, "_q", "_s", by)
    return both.withColumn("var", F.col("_s") - F.col("mean") * F.col("mean")).drop("_q", "_s")


def difference_variance(image: DataFrame, by: Planes = ()) -> DataFrame:
    """var: variance of the differences to the four neighbours, 0 towards the border."""
    wx, wy = along("x", by), along("y", by)
    diffs = [F.coalesce(F.col("v") - f("v").over(w), F.lit(0.0)) for w in (wx, wy) for f in (F.lag, F.lead)]
    named = image.select("*", *[d.alias(f"_d{i}") for i, d in enumerate(diffs)])
    mean = sum((F.col(f"_d{i}") for i in range(1, 4)), F.col("_d0")) / 4
    square = sum((F.col(f"_d{i}") * F.col(f"_d{i}") for i in range(1, 4)), F.col("_d0") * F.col("_d0")) / 4
    return named.withColumn("var", square - mean * mean).drop(*[f"_d{i}" for i in range(4)])


def box_extreme(image: DataFrame, radius: int, largest: bool, v: str = "v", out: str = "v", by: Planes = ()) -> DataFrame:
    """Dilation (largest) or erosion by a square, as two running extremes."""
    f = F.max if largest else F.min
    across = image.withColumn(out, f(v).over(along("x", by).rowsBetween(-radius, radius)))
    return across.withColumn(out, f(out).over(along("y", by).rowsBetween(-radius, radius)))


def neighbour_sum(image: DataFrame, out: str = "s", by: Planes = ()) -> DataFrame:
    """Sum of the eight neighbours: row sums of three, then three of them, less the pixel."""
    rows = image.withColumn("_r", F.sum("v").over(along("x", by).rowsBetween(-1, 1)))
    return rows.withColumn(out, F.sum("_r").over(along("y", by).rowsBetween(-1, 1)) - F.col("v")).drop("_r")


def hessian(image: DataFrame, by: Planes = ()) -> DataFrame:
    """e1 >= e2: eigenvalues of the matrix of second differences (gradients of gradients)."""
    wx, wy = along("x", by), along("y", by)
    first = image.withColumn("_gx", gradient(wx)).withColumn("_gy", gradient(wy))
    second = first.withColumn("_xx", gradient(wx, "_gx")).withColumn("_xy", gradient(wy, "_gx")).withColumn("_yy", gradient(wy, "_gy"))
    half, root = (F.col("_xx") + F.col("_yy")) / 2, F.sqrt((F.col("_xx") - F.col("_yy")) * (F.col("_xx") - F.col("_yy")) / 4 + F.col("_xy") * F.col("_xy"))
    return second.withColumn("e1", half + root).withColumn("e2", half - root).drop("_gx", "_gy", "_xx", "_xy", "_yy")


def scharr(image: DataFrame, by: Planes = ()) -> DataFrame:
    """gx, gy by the 3 x 3 Scharr kernels, reflect-101 borders, and their magnitude."""
    smooth = [3.0, 10.0, 3.0]
    wx, wy = along("x", by), along("y", by)

    def central(v: str, w) -> Column:
        return F.when(F.lag(v).over(w).isNull() | F.lead(v).over(w).isNull(), F.lit(0.0)).otherwise(F.lead(v).over(w) - F.lag(v).over(w))

    gx = convolved(image.withColumn("_dx", central("v", wx)), smooth, "y", "_dx", "gx", by)
    both = convolved(gx.withColumn("_dy", central("v", wy)), smooth, "x", "_dy", "gy", by).drop("_dx", "_dy")
    return both.withColumn("magnitude", F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")))


def anisotropy(image: DataFrame, by: Planes = ()) -> DataFrame:
    """Ratio of the eigenvalues of the structure tensor (Scharr gradients, 5 x 5 Gaussian window); null where the smaller is 0."""
    g = scharr(image, by)
    for a, b, out in (("gx", "gx", "_xx"), ("gx", "gy", "_xy"), ("gy", "gy", "_yy")):
        g = blurred(g.withColumn(out, F.col(a) * F.col(b)), 1.1, 2, out, out, by)
    trace, det = F.col("_xx") + F.col("_yy"), F.col("_xx") * F.col("_yy") - F.col("_xy") * F.col("_xy")
    root = F.sqrt(F.greatest(trace * trace / 4 - det, F.lit(0.0)))
    return g.withColumn("anisotropy", F.try_divide(trace / 2 + root, trace / 2 - root)).drop("_xx", "_xy", "_yy")


def fixed_boundaries(image: DataFrame, by: Planes = ()) -> DataFrame:
    """v: 0 where a non-zero label differs from a non-zero one before it along y (cyclically), then along x."""
    for axis in ("y", "x"):
        line = along(axis, by)
        last = F.last("v").over(line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        before = F.coalesce(F.lag("v").over(line), last)
        image = image.withColumn("v", F.when((F.col("v") != before) & (F.col("v") != 0) & (before != 0), F.lit(0)).otherwise(F.col("v")))
    return image


def equalised(image: DataFrame, height: int, width: int, clip: float = 2.0, by: Planes = ()) -> DataFrame:
    """(*by, y, x, v): contrast-limited adaptive equalisation of values 0 to 255, in 8 x 8 tiles blended by tent weights.

    A tile's clipped histogram gives a table of 256 entries; a pixel weighs the tables of the tiles whose window (twice
    the tile, from half a tile before its corner) covers it. A plane has 64 tables of 256 numbers, joined by hash.
    """
    bh, bw = (height + 7) // 8, (width + 7) // 8
    pixels = image.select(*by, "y", "x", F.col("v").cast("int").alias("bin"))
    counts = pixels.groupBy(*by, F.floor(F.col("y") / bh).alias("ty"), F.floor(F.col("x") / bw).alias("tx"), "bin").agg(F.count(F.lit(1)).alias("n"))
    tiles = counts.select(*by, "ty", "tx").distinct()
    full = tiles.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(255)))).join(counts, [*by, "ty", "tx", "bin"], "left").na.fill(0, ["n"])
    tile = W.partitionBy(*by, "ty", "tx")
    upto = tile.orderBy("bin")
    limit = F.lit(clip) * F.sum("n").over(tile) / 256
    full = full.withColumn("kept", F.least(F.col("n").cast("double"), limit)).withColumn("over", F.col("n") - F.col("kept"))
    full = full.withColumn("low", F.coalesce(F.sum("kept").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))).withColumn("excess", F.sum("over").over(tile))
    scale = 255.0 / (F.max(F.when(F.col("bin") == 255, F.col("low"))).over(tile) + F.col("excess"))
    full = full.withColumn("high", (F.col("low") + (F.col("bin") + 1) * F.col("excess") / 256) * scale)
    table = full.withColumn("to", F.rint((F.coalesce(F.lag("high").over(upto), F.lit(0.0)) + F.col("high")) / 2)).select(*by, "ty", "tx", "bin", "to")
    near = lambda c, b: F.filter(F.sequence(F.lit(0), F.lit(7)), lambda t: (F.col(c) >= t * b - b // 2) & (F.col(c) <= t * b - b // 2 + 2 * b))
    spread = pixels.withColumn("ty", F.explode(near("y", bh))).withColumn("tx", F.explode(near("x", bw)))
    wy = bh - F.abs(F.col("y") - (F.col("ty") * bh - bh // 2) - bh)
    wx = bw - F.abs(F.col("x") - (F.col("tx") * bw - bw // 2) - bw)
    mixed = spread.join(table, [*by, "ty", "tx", "bin"]).withColumn("w", (wy * wx).cast("double"))
    return mixed.groupBy(*by, "y", "x").agg((F.sum(F.col("to") * F.col("w")) / F.sum("w")).alias("v"))


def decile_counts(image: DataFrame, sigma: float, radius: int, by: Planes = ()) -> DataFrame:
    """image with h0 to h9: the blurred masks of the values in each tenth of [0, 1): a local histogram of soft window."""
    for i in range(10):
        image = image.withColumn(f"h{i}", ((F.col("v") >= i / 10) & (F.col("v") < (i + 1) / 10)).cast("double"))
        image = blurred(image, sigma, radius, f"h{i}", f"h{i}", by)
    return image
