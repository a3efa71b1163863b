"""Queries of evaluation, clean-up and image neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..operators import cleanup as CL, evaluate as E, image as I, overlap as O
from .registry import IMG, VOX, img, query, vox

REGIONS = f"""{VOX}, ov AS (SELECT z, label_a AS gt, label_b AS seg, count(*) AS ov FROM vox WHERE label_a > 0 GROUP BY ALL),
  gt AS (SELECT z, gt, sum(ov)::BIGINT AS size FROM ov GROUP BY ALL HAVING sum(ov) >= 10), sg AS (SELECT z, seg, sum(ov) AS seg_size FROM ov WHERE seg > 0 GROUP BY ALL HAVING sum(ov) >= 10),
  p AS (SELECT *, ov / size > 1 - 0.8::DOUBLE AS mg, ov / seg_size > 1 - 0.8::DOUBLE AS ms FROM ov JOIN gt USING (z, gt) JOIN sg USING (z, seg)),
  q AS (SELECT *, coalesce(sum((mg AND ms)::INT) OVER (PARTITION BY z, gt ORDER BY ov DESC, seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
  r AS (SELECT *, min(CASE WHEN mg AND NOT ms THEN gt END) OVER (PARTITION BY z, seg) AS claim FROM q WHERE before = 0),
  f AS (SELECT z, gt, bool_or(mg AND ms) AS good, bool_or(mg AND NOT ms) AS merge, bool_or(NOT mg AND ms) AS split, bool_or(NOT mg AND NOT ms) AS adjust, bool_or(coalesce(mg AND NOT ms AND claim = gt, false)) AS claims FROM r GROUP BY ALL),
  regions AS (SELECT z, gt, size, CASE WHEN good THEN 'good' WHEN merge THEN 'merge' WHEN split THEN 'split' WHEN adjust THEN 'adjust' ELSE 'none' END AS region, coalesce(merge AND NOT good AND claims, false) AS new_merge FROM gt LEFT JOIN f USING (z, gt))"""


def regions(spark, d):
    return E.scored_regions(vox(spark, d), "label_a", "label_b", 10, 0.8)


@query(f"WITH {REGIONS} SELECT * FROM regions")
def a21_split_merge_regions(spark, d):
    return regions(spark, d)


@query(f"WITH {REGIONS} SELECT count(*) AS n_regions, count(*) FILTER (region = 'good') AS n_good, count(*) FILTER (region = 'split') AS n_split, count(*) FILTER (region = 'merge') AS n_merge, count(*) FILTER (region = 'adjust') AS n_adjust, count(*) FILTER (new_merge) AS n_unique_merge, sum(size)::BIGINT AS area, sum(CASE WHEN region = 'good' THEN size ELSE 0 END)::BIGINT AS good_area FROM regions")
def a22_stack_summary(spark, d):
    return E.summary(regions(spark, d))


@query(f"WITH {VOX}, s AS (SELECT z, label_a AS label, count(*) AS area FROM vox WHERE label_a > 0 GROUP BY ALL) SELECT z, label, area, CASE WHEN area >= 55 THEN sum((area >= 55)::INT) OVER (PARTITION BY z ORDER BY label ROWS UNBOUNDED PRECEDING) ELSE 0 END::BIGINT AS new FROM s")
def a23_profile_filter(spark, d):
    return E.profiles(vox(spark, d), "label_a", 55)


@query()
def g8_small_segment_join(spark, d):
    """In sequence per block (here: per plane); tests compare with a plain loop."""
    v = vox(spark, d).withColumn("label", F.when(F.col("label_a") > 0, F.col("label_a") * 10 + F.col("label_b")).otherwise(0))
    steps = F.array(F.struct(F.lit(0).alias("dy"), F.lit(1).alias("dx")), F.struct(F.lit(1).alias("dy"), F.lit(0).alias("dx")))
    own = v.select("z", "y", "x", F.col("label").alias("a"), F.col("p").alias("pa"))
    moved = v.withColumn("s", F.explode(steps)).select("z", (F.col("y") - F.col("s.dy")).alias("y"), (F.col("x") - F.col("s.dx")).alias("x"), F.col("label").alias("b"), F.col("p").alias("pb"))
    faces = own.join(moved, ["z", "y", "x"]).where("a <> b and a > 0 and b > 0")
    both = faces.select("z", F.explode(F.array(F.struct("a", "b", F.col("pa").alias("p")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("pb").alias("p")))).alias("f"))
    stats = both.groupBy(F.col("z").cast("long").alias("block"), "f.a", "f.b").agg(F.count(F.lit(1)).alias("n"), F.sum("f.p").alias("psum"))
    sizes = O.areas(v, "label", "z").select(F.col("z").cast("long").alias("block"), "label", "area")
    return CL.agglomerated(stats, sizes, 12)


SIDES = f"""{VOX}, s AS (SELECT * FROM (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) t(dz, dy, dx)), w AS (SELECT z, y, x, CASE WHEN z = 1 AND x BETWEEN 5 AND 8 AND y BETWEEN 5 AND 8 THEN 99 WHEN x < 10 THEN 1 ELSE 2 END AS label FROM vox)"""


@query(f"""WITH {SIDES}, f AS (SELECT DISTINCT a.label AS a, b.label AS b FROM w a, s JOIN w b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx WHERE a.label <> b.label), one AS (SELECT a AS label, min(b)::BIGINT AS target FROM f GROUP BY 1 HAVING count(*) = 1)
  SELECT label::BIGINT AS label, target FROM one WHERE label NOT IN (SELECT label FROM w WHERE z IN (0, (SELECT max(z) FROM w)) OR y IN (0, 19) OR x IN (0, 19))""")
def g9_singly_connected(spark, d):
    box = (F.col("z") == 1) & F.col("x").between(5, 8) & F.col("y").between(5, 8)
    v = vox(spark, d).withColumn("label", F.when(box, 99).when(F.col("x") < 10, 1).otherwise(2).cast("long"))
    return CL.singly_connected(v)


SPARSE = f"{VOX}, w AS (SELECT z, y, x, CASE WHEN p > 60 THEN (label_a * 10 + label_b)::BIGINT ELSE 0 END AS l FROM vox), lab AS (SELECT DISTINCT z, l FROM w WHERE l > 0)"


def sparse(spark, d):
    return vox(spark, d).withColumn("label", F.when(F.col("p") > 60, F.col("label_a") * 10 + F.col("label_b")).otherwise(0).cast("long"))


@query(f"""WITH {SPARSE}, miss AS (SELECT z, l FROM lab a WHERE z <= (SELECT max(z) FROM w) - 3 AND NOT EXISTS (SELECT 1 FROM lab b WHERE b.z = a.z + 1 AND b.l = a.l)),
  m AS (SELECT a.z, a.z + k AS zz, a.y, a.x, a.l FROM w a JOIN miss USING (z, l), range(2, 4) t(k) JOIN w c ON c.z = a.z + k AND c.y = a.y AND c.x = a.x AND c.l = a.l)
  SELECT DISTINCT g::INT AS z, y, x, l AS label FROM m, unnest(range(z + 1, zz)) u(g)""")
def g10_skip_repairs(spark, d):
    return CL.skip_repairs(sparse(spark, d), 3)


@query(f"""WITH {SPARSE}, pl AS (SELECT z, count(*) AS plane FROM w GROUP BY 1), ar AS (SELECT z, l, count(*) AS area FROM w WHERE l > 0 GROUP BY ALL), st(step) AS (VALUES (1), (-1)),
  miss AS (SELECT ar.*, step FROM ar JOIN pl USING (z), st WHERE area / plane >= 0.005 AND EXISTS (SELECT 1 FROM pl q WHERE q.z = ar.z + step) AND NOT EXISTS (SELECT 1 FROM lab b WHERE b.z = ar.z + step AND b.l = ar.l)),
  o AS (SELECT m.z, m.step, m.l, m.area, c.l AS partner, count(*) AS ov FROM miss m JOIN w a ON a.z = m.z AND a.l = m.l JOIN w c ON c.z = m.z + m.step AND c.y = a.y AND c.x = a.x GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY z, step, l ORDER BY ov DESC, partner) AS r FROM o) SELECT z, (z + step)::INT AS to_z, l AS label, partner AS target FROM r WHERE r = 1 AND ov / area >= 0.6""")
def g11_branch_repairs(spark, d):
    return CL.branch_repairs(sparse(spark, d), "label", 0.6, 0.005)


#: Rows of a plane of the image stack; the last plane may have fewer.
ROWS = 64
BY = ("z",)


def _image(spark, d):
    """All rows of the image, as a stack of planes."""
    y = F.col("y")
    return img(spark, d).select(F.floor(y / ROWS).cast("int").alias("z"), (y % ROWS).alias("y"), "x", "v")


STACK = f"{IMG}, i AS (SELECT y // {ROWS} AS z, (y % {ROWS})::INT AS y, x, v, max(y % {ROWS}) OVER (PARTITION BY y // {ROWS}) AS ly FROM img)"


def _conv_sql(source: str, value: str, weights: list[float], axis: str, out: str) -> str:
    """A filter with reflect-101 borders, as a self-join."""
    other, last = ("y", "63") if axis == "x" else ("x", "a.ly")
    taps = ", ".join(f"({k}, {w!r}::DOUBLE)" for k, w in zip(range(-(len(weights) // 2), len(weights) // 2 + 1), weights))
    at = f"(CASE WHEN a.{axis} + k < 0 THEN -(a.{axis} + k) WHEN a.{axis} + k > {last} THEN 2 * {last} - (a.{axis} + k) ELSE a.{axis} + k END)"
    return f"{out} AS (SELECT a.z, a.y, a.x, a.ly, sum(w * b.{value}) AS v FROM {source} a, (VALUES {taps}) t(k, w) JOIN {source} b ON b.z = a.z AND b.{other} = a.{other} AND b.{axis} = {at} GROUP BY ALL)"


def _blur_sql(source: str, value: str, sigma: float, radius: int, out: str) -> str:
    k = I.kernel(sigma, radius)
    return f"{_conv_sql(source, value, k, 'x', out + '_x')}, {_conv_sql(out + '_x', 'v', k, 'y', out)}"


@query(f"WITH {STACK}, {_blur_sql('i', 'v', 1.5, 4, 'b')} SELECT z, y, x, CASE WHEN round(v, 6) = 0 THEN 0 ELSE round(v, 6) END AS v FROM b")
def w1_gaussian_blur(spark, d):
    return I.blurred(_image(spark, d), 1.5, 4, by=BY).select("z", "y", "x", F.round("v", 6).alias("v"))


GRAD = "CASE WHEN lag({v}) OVER {w} IS NULL THEN lead({v}) OVER {w} - {v} WHEN lead({v}) OVER {w} IS NULL THEN {v} - lag({v}) OVER {w} ELSE (lead({v}) OVER {w} - lag({v}) OVER {w}) / 2 END"
WIN = "WINDOW wx AS (PARTITION BY z, y ORDER BY x), wy AS (PARTITION BY z, x ORDER BY y)"


@query(f"WITH {STACK} SELECT z, y, x, CASE WHEN round({GRAD.format(v='v', w='wx')}, 7) = 0 THEN 0 ELSE round({GRAD.format(v='v', w='wx')}, 7) END AS gx, CASE WHEN round({GRAD.format(v='v', w='wy')}, 7) = 0 THEN 0 ELSE round({GRAD.format(v='v', w='wy')}, 7) END AS gy FROM i {WIN}")
def w2_gradient(spark, d):
    wx, wy = I.along("x", BY), I.along("y", BY)
    return _image(spark, d).select("z", "y", "x", F.round(I.gradient(wx), 7).alias("gx"), F.round(I.gradient(wy), 7).alias("gy"))


CENTRAL = "CASE WHEN lag(v) OVER {w} IS NULL OR lead(v) OVER {w} IS NULL THEN 0 ELSE lead(v) OVER {w} - lag(v) OVER {w} END"
SCHARR = f"{STACK}, c AS (SELECT z, y, x, ly, {CENTRAL.format(w='wx')} AS dx, {CENTRAL.format(w='wy')} AS dy FROM i {WIN}), {_conv_sql('c', 'dx', [3.0, 10.0, 3.0], 'y', 'gx')}, {_conv_sql('c', 'dy', [3.0, 10.0, 3.0], 'x', 'gy')}, g AS (SELECT z, y, x, gx.ly, gx.v AS gx, gy.v AS gy FROM gx JOIN gy USING (z, y, x))"


@query(f"WITH {SCHARR} SELECT z, y, x, CASE WHEN round(gx, 5) = 0 THEN 0 ELSE round(gx, 5) END AS gx, CASE WHEN round(gy, 5) = 0 THEN 0 ELSE round(gy, 5) END AS gy, CASE WHEN round(sqrt(gx * gx + gy * gy), 5) = 0 THEN 0 ELSE round(sqrt(gx * gx + gy * gy), 5) END AS magnitude FROM g")
def w3_scharr(spark, d):
    return I.scharr(_image(spark, d), BY).select("z", "y", "x", *[F.round(c, 5).alias(c) for c in ("gx", "gy", "magnitude")])


@query(f"WITH {SCHARR}, t AS (SELECT z, y, x, ly, gx * gx AS xx, gx * gy AS xy, gy * gy AS yy FROM g), {_blur_sql('t', 'xx', 1.1, 2, 'bxx')}, {_blur_sql('t', 'xy', 1.1, 2, 'bxy')}, {_blur_sql('t', 'yy', 1.1, 2, 'byy')}, e AS (SELECT z, y, x, bxx.v + byy.v AS tr, bxx.v * byy.v - bxy.v * bxy.v AS det FROM bxx JOIN bxy USING (z, y, x) JOIN byy USING (z, y, x)) SELECT z, y, x, CASE WHEN round((tr / 2 + sqrt(greatest(tr * tr / 4 - det, 0))) / (tr / 2 - sqrt(greatest(tr * tr / 4 - det, 0))), 3) = 0 THEN 0 ELSE round((tr / 2 + sqrt(greatest(tr * tr / 4 - det, 0))) / (tr / 2 - sqrt(greatest(tr * tr / 4 - det, 0))), 3) END AS anisotropy FROM e")
def w3_anisotropy(spark, d):
    return I.anisotropy(_image(spark, d), BY).select("z", "y", "x", F.round("anisotropy", 3).alias("anisotropy"))


DIFFS = ["coalesce(v - lag(v) OVER wx, 0)", "coalesce(v - lead(v) OVER wx, 0)", "coalesce(v - lag(v) OVER wy, 0)", "coalesce(v - lead(v) OVER wy, 0)"]


@query(f"WITH {STACK}, t AS (SELECT z, y, x, {', '.join(f'{e} AS d{i}' for i, e in enumerate(DIFFS))} FROM i {WIN}) SELECT z, y, x, CASE WHEN round((d0 * d0 + d1 * d1 + d2 * d2 + d3 * d3) / 4 - pow((d0 + d1 + d2 + d3) / 4, 2), 6) = 0 THEN 0 ELSE round((d0 * d0 + d1 * d1 + d2 * d2 + d3 * d3) / 4 - pow((d0 + d1 + d2 + d3) / 4, 2), 6) END AS var FROM t")
def w4_difference_variance(spark, d):
    return I.difference_variance(_image(spark, d), BY).select("z", "y", "x", F.round("var", 6).alias("var"))


@query(f"WITH {STACK}, {_blur_sql('i', 'v', 1.0, 3, 'b1')}, {_blur_sql('i', 'v', 2.0, 6, 'b2')} SELECT z, y, x, CASE WHEN round(b2.v - b1.v, 6) = 0 THEN 0 ELSE round(b2.v - b1.v, 6) END AS dog FROM b1 JOIN b2 USING (z, y, x)")
def w5_difference_of_gaussians(spark, d):
    both = I.blurred(I.blurred(_image(spark, d), 1.0, 3, "v", "b1", BY), 2.0, 6, "v", "b2", BY)
    return both.select("z", "y", "x", F.round(F.col("b2") - F.col("b1"), 6).alias("dog"))


@query(f"WITH {STACK}, f AS (SELECT z, y, x, {GRAD.format(v='v', w='wx')} AS gx, {GRAD.format(v='v', w='wy')} AS gy FROM i {WIN}), s AS (SELECT z, y, x, {GRAD.format(v='gx', w='wx')} AS xx, {GRAD.format(v='gx', w='wy')} AS xy, {GRAD.format(v='gy', w='wy')} AS yy FROM f {WIN}) SELECT z, y, x, CASE WHEN round((xx + yy) / 2 + sqrt(pow(xx - yy, 2) / 4 + xy * xy), 5) = 0 THEN 0 ELSE round((xx + yy) / 2 + sqrt(pow(xx - yy, 2) / 4 + xy * xy), 5) END AS e1, CASE WHEN round((xx + yy) / 2 - sqrt(pow(xx - yy, 2) / 4 + xy * xy), 5) = 0 THEN 0 ELSE round((xx + yy) / 2 - sqrt(pow(xx - yy, 2) / 4 + xy * xy), 5) END AS e2 FROM s")
def w6_hessian(spark, d):
    return I.hessian(_image(spark, d), BY).select("z", "y", "x", F.round("e1", 5).alias("e1"), F.round("e2", 5).alias("e2"))


@query(f"WITH {STACK} SELECT z, y, x, CASE WHEN round(coalesce(lead(v) OVER wy, 0), 7) = 0 THEN 0 ELSE round(coalesce(lead(v) OVER wy, 0), 7) END AS up, CASE WHEN round(coalesce(lag(v) OVER wy, 0), 7) = 0 THEN 0 ELSE round(coalesce(lag(v) OVER wy, 0), 7) END AS down, CASE WHEN round(coalesce(lead(v) OVER wx, 0), 7) = 0 THEN 0 ELSE round(coalesce(lead(v) OVER wx, 0), 7) END AS lft, CASE WHEN round(coalesce(lag(v) OVER wx, 0), 7) = 0 THEN 0 ELSE round(coalesce(lag(v) OVER wx, 0), 7) END AS rgt FROM i {WIN}")
def w7_zero_fill_shifts(spark, d):
    i = _image(spark, d)
    for name, dy, dx in (("up", -1, 0), ("down", 1, 0), ("lft", 0, -1), ("rgt", 0, 1)):
        i = I.shifted(i, dy, dx, name, by=BY)
    return i.select("z", "y", "x", *[F.round(c, 7).alias(c) for c in ("up", "down", "lft", "rgt")])


@query(f"WITH {STACK} SELECT a.z, a.y, a.x, CASE WHEN round(coalesce(b.v, 0), 7) = 0 THEN 0 ELSE round(coalesce(b.v, 0), 7) END AS ne, CASE WHEN round(coalesce(c.v, 0), 7) = 0 THEN 0 ELSE round(coalesce(c.v, 0), 7) END AS sw FROM i a LEFT JOIN i b ON b.z = a.z AND b.y = a.y + 1 AND b.x = a.x - 1 LEFT JOIN i c ON c.z = a.z AND c.y = a.y - 1 AND c.x = a.x + 1")
def w8_diagonal_shifts(spark, d):
    i = I.shifted(I.shifted(_image(spark, d), -1, 1, "ne", by=BY), 1, -1, "sw", by=BY)
    return i.select("z", "y", "x", F.round("ne", 7).alias("ne"), F.round("sw", 7).alias("sw"))


@query(f"WITH {STACK}, q AS (SELECT z, y, x, ly, v * v AS v FROM i), {_blur_sql('i', 'v', 1.5, 4, 'b')}, {_blur_sql('q', 'v', 1.5, 4, 's')} SELECT z, y, x, CASE WHEN round(b.v, 6) = 0 THEN 0 ELSE round(b.v, 6) END AS mean, CASE WHEN round(s.v - b.v * b.v, 6) = 0 THEN 0 ELSE round(s.v - b.v * b.v, 6) END AS var FROM b JOIN s USING (z, y, x)")
def w9_local_mean_variance(spark, d):
    return I.local_variance(_image(spark, d), 1.5, 4, BY).select("z", "y", "x", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


MORPH = "{f}({f}(v)) OVER"


def _box_sql(source, f, out):
    return f"{out}_x AS (SELECT z, y, x, {f}(v) OVER (PARTITION BY z, y ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM {source}), {out} AS (SELECT z, y, x, {f}(v) OVER (PARTITION BY z, x ORDER BY y ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM {out}_x)"


@query(f"WITH {STACK}, {_box_sql('i', 'min', 'er')}, {_box_sql('i', 'max', 'di')}, {_box_sql('er', 'max', 'op')}, {_box_sql('di', 'min', 'cl')} SELECT z, y, x, CASE WHEN round(er.v, 7) = 0 THEN 0 ELSE round(er.v, 7) END AS eroded, CASE WHEN round(di.v, 7) = 0 THEN 0 ELSE round(di.v, 7) END AS dilated, CASE WHEN round(op.v, 7) = 0 THEN 0 ELSE round(op.v, 7) END AS opened, CASE WHEN round(cl.v, 7) = 0 THEN 0 ELSE round(cl.v, 7) END AS closed FROM er JOIN di USING (z, y, x) JOIN op USING (z, y, x) JOIN cl USING (z, y, x)")
def w10_morphology(spark, d):
    i = I.box_extreme(I.box_extreme(_image(spark, d), 2, False, "v", "eroded", BY), 2, True, "v", "dilated", BY)
    i = I.box_extreme(I.box_extreme(i, 2, True, "eroded", "opened", BY), 2, False, "dilated", "closed", BY)
    return i.select("z", "y", "x", *[F.round(c, 7).alias(c) for c in ("eroded", "dilated", "opened", "closed")])


@query(f"WITH {STACK} SELECT a.z, a.y, a.x, CASE WHEN round(coalesce(sum(b.v), 0), 6) = 0 THEN 0 ELSE round(coalesce(sum(b.v), 0), 6) END AS s FROM i a LEFT JOIN i b ON b.z = a.z AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY ALL")
def w11_hollow_sum(spark, d):
    return I.neighbour_sum(_image(spark, d), by=BY).select("z", "y", "x", F.round("s", 6).alias("s"))


FIXED = f"""{VOX}, a AS (SELECT z, y, x, label_a AS v FROM vox), b AS (SELECT z, y, x, v, coalesce(lag(v) OVER (PARTITION BY z, x ORDER BY y), last_value(v) OVER (PARTITION BY z, x ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS q FROM a),
  c AS (SELECT z, y, x, CASE WHEN v <> q AND v <> 0 AND q <> 0 THEN 0 ELSE v END AS v FROM b), e AS (SELECT z, y, x, v, coalesce(lag(v) OVER (PARTITION BY z, y ORDER BY x), last_value(v) OVER (PARTITION BY z, y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS q FROM c)"""


@query(f"WITH {FIXED} SELECT z, y, x, (CASE WHEN v <> q AND v <> 0 AND q <> 0 THEN 0 ELSE v END)::BIGINT AS v FROM e")
def w13_missing_boundaries(spark, d):
    return I.fixed_boundaries(vox(spark, d).select("z", "y", "x", F.col("label_a").alias("v")), BY).select("z", "y", "x", F.col("v").cast("long").alias("v"))


@query(f"WITH {VOX}, l AS (SELECT DISTINCT label_a, label_b FROM vox) SELECT label_a, label_b, dense_rank() OVER (ORDER BY label_a)::INT AS rank, row_number() OVER (ORDER BY label_a, label_b)::INT AS link FROM l")
def w14_ranks_and_link_ids(spark, d):
    """Dense ranks, and row-first link ids, over a table of distinct labels."""
    pairs = vox(spark, d).select("label_a", "label_b").distinct()
    return pairs.withColumn("rank", F.dense_rank().over(W.orderBy("label_a"))).withColumn("link", F.row_number().over(W.orderBy("label_a", "label_b")))


@query(f"WITH {IMG}, h AS (SELECT (y // 64)::BIGINT AS tile, least(greatest(floor((v + 1) * 128), 0), 255)::BIGINT AS bin, count(*) AS n FROM img GROUP BY ALL) SELECT tile, bin, sum(n) OVER (PARTITION BY tile ORDER BY bin ROWS UNBOUNDED PRECEDING)::BIGINT AS cdf FROM h")
def w16_histogram_cdf(spark, d):
    b = F.least(F.greatest(F.floor((F.col("v") + 1) * 128), F.lit(0)), F.lit(255)).cast("long")
    h = img(spark, d).groupBy(F.floor(F.col("y") / 64).alias("tile"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("tile", "bin", F.sum("n").over(W.partitionBy("tile").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)).alias("cdf"))


TILE, CLIP = 8, 2
EQUALISE = f"""{STACK}, px AS (SELECT z, y, x, least(greatest(floor((v + 1) * 128), 0), 255)::INT AS bin FROM i), cnt AS (SELECT z, y // 8 AS ty, x // 8 AS tx, bin, count(*) AS n FROM px GROUP BY ALL), ti AS (SELECT DISTINCT z, ty, tx FROM cnt),
  h AS (SELECT ti.z, ti.ty, ti.tx, b.bin, coalesce(n, 0) AS n FROM ti, range(256) b(bin) LEFT JOIN cnt ON cnt.z = ti.z AND cnt.ty = ti.ty AND cnt.tx = ti.tx AND cnt.bin = b.bin),
  k AS (SELECT *, least(n, 2.0::DOUBLE * sum(n) OVER (PARTITION BY z, ty, tx) / 256) AS kept FROM h), c AS (SELECT *, coalesce(sum(kept) OVER (PARTITION BY z, ty, tx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low, sum(n - kept) OVER (PARTITION BY z, ty, tx) AS excess FROM k),
  s AS (SELECT *, (low + (bin + 1) * excess / 256) * (255.0::DOUBLE / (max(CASE WHEN bin = 255 THEN low END) OVER (PARTITION BY z, ty, tx) + excess)) AS high FROM c), t AS (SELECT z, ty, tx, bin, round_even((coalesce(lag(high) OVER (PARTITION BY z, ty, tx ORDER BY bin), 0) + high) / 2, 0) AS v FROM s),
  sp AS (SELECT px.z, y, x, px.bin, ty, tx, v, (8 - abs(y - (ty * 8 - 4) - 8)) * (8 - abs(x - (tx * 8 - 4) - 8)) AS w FROM px JOIN t ON t.z = px.z AND t.bin = px.bin AND y BETWEEN ty * 8 - 4 AND ty * 8 + 12 AND x BETWEEN tx * 8 - 4 AND tx * 8 + 12)"""


@query(f"WITH {EQUALISE} SELECT z, y, x, round(sum(v * w) / sum(w), 4) AS v FROM sp GROUP BY ALL")
def f2_adaptive_equalisation(spark, d):
    b = F.least(F.greatest(F.floor((F.col("v") + 1) * 128), F.lit(0)), F.lit(255))
    return I.equalised(_image(spark, d).withColumn("v", b), ROWS, 64, by=BY).select("z", "y", "x", F.round("v", 4).alias("v"))
