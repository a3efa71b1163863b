"""Queries of joins, aggregations, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import scalars as S
from ..operators import components as C, matching as M, overlap as O, volume as V
from ..session import written
from .projections import OVERLAPS, overlaps
from .registry import DENSE, IMG, PAIRS, VOX, dense_pairs, img, pairgraph, query, table, vox


def rows():
    return F.count(F.lit(1))


@query(f"WITH {VOX} SELECT label_a AS l1, label_b AS l2, count(*) AS ov FROM vox WHERE label_a > 0 AND label_b > 0 GROUP BY ALL")
def j1_aligned_join(spark, d):
    v = vox(spark, d)
    return O.aligned(v, v, "label_a", "label_b")


SEGS = f"""{VOX}, segs AS (SELECT z, y, x, 1 AS seg, label_a AS label FROM vox UNION ALL SELECT z, y, x, 2, CASE WHEN label_b > 2 THEN 10 + label_b ELSE 0 END FROM vox UNION ALL SELECT z, y, x, 3, CASE WHEN p > 20 THEN 20 + label_a % 3 ELSE 0 END FROM vox)"""


def segs(spark, d):
    """Three candidate labellings of each plane."""
    v = vox(spark, d)
    parts = [(1, F.col("label_a")), (2, F.when(F.col("label_b") > 2, 10 + F.col("label_b")).otherwise(0)), (3, F.when(F.col("p") > 20, 20 + F.col("label_a") % 3).otherwise(0))]
    return v.withColumn("s", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), c.cast("long").alias("label")) for i, c in parts]))).select("z", "y", "x", "s.seg", "s.label")


@query(f"WITH {SEGS} SELECT a.label AS l1, b.label AS l2, count(*) AS n FROM segs a JOIN segs b USING (z, y, x) WHERE a.seg < b.seg AND a.label > 0 AND b.label > 0 GROUP BY ALL")
def j2_candidate_self_join(spark, d):
    """Pairs of a pixel's labels come from one array per pixel instead of a self-join: one shuffle, not two."""
    at = segs(spark, d).where("label > 0").groupBy("z", "y", "x").agg(F.array_sort(F.collect_list(F.struct("seg", "label"))).alias("s"))
    pairs = at.select(F.explode(F.expr("flatten(transform(s, (a, i) -> transform(slice(s, i + 2, size(s)), b -> struct(a.label as l1, b.label as l2))))")).alias("p"))
    return pairs.groupBy("p.l1", "p.l2").agg(rows().alias("n"))


@query(f"WITH {VOX} SELECT dz::INT AS dz, a.label_a AS l1, b.label_a AS l2, count(*) AS ov FROM vox a, range(1, 4) t(dz) JOIN vox b ON b.z = a.z + dz AND b.y = a.y AND b.x = a.x WHERE a.label_a > 0 AND b.label_a > 0 GROUP BY ALL")
def j3_interslice_links(spark, d):
    return O.links(vox(spark, d), "label_a", 3)


MERGES = f"""{OVERLAPS}, m AS (SELECT l1 AS a, 100 + l2 AS b FROM o WHERE ov > 0.14 * a1 UNION ALL SELECT label_a, label_a FROM vox WHERE label_a > 0 GROUP BY 1 UNION ALL SELECT 100 + label_b, 100 + label_b FROM vox GROUP BY 1),
  e AS (SELECT a AS u, b AS v FROM m UNION SELECT b, a FROM m),
  reach AS (WITH RECURSIVE r(id, to_) AS (SELECT u, v FROM e UNION SELECT r.id, e.v FROM r JOIN e ON r.to_ = e.u) SELECT id, least(id, min(to_)) AS root FROM r GROUP BY id),
  remap AS (SELECT id AS old, dense_rank() OVER (ORDER BY root) AS new FROM reach)"""


def merges(spark, d):
    """Merges of the two labellings (the second's ids + 100), with identities."""
    found = overlaps(spark, d).where("ov > 0.14 * a1").select(F.col("l1").alias("a"), (F.col("l2") + 100).alias("b"))
    v = vox(spark, d)
    labels = v.select(F.explode(F.array(F.col("label_a"), F.col("label_b") + 100)).alias("label"))
    return C.with_identities(found, labels)


@query(f"WITH RECURSIVE {MERGES} SELECT z, y, x, coalesce(new, 0)::BIGINT AS label FROM vox LEFT JOIN remap ON label_a = old")
def j4_remap_lookup(spark, d):
    remap = C.global_map(merges(spark, d))
    return C.remapped(vox(spark, d).select("z", "y", "x", F.col("label_a").alias("label")), remap)


@query(f"WITH {OVERLAPS} SELECT l1, l2, ov, a1, a2 FROM o")
def j5_area_lookup(spark, d):
    return overlaps(spark, d)


THETA = "ov {c} 40 OR (ov {c} 12 AND (ov {c} 0.9 * a1 OR ov {c} 0.9 * a2 OR (ov {c} 0.1 * a1 AND ov {c} 0.1 * a2)))"
DENSE_AREAS = f"{DENSE}, o AS (SELECT l1, l2, ov, sum(ov) OVER (PARTITION BY l1)::BIGINT AS a1, sum(ov) OVER (PARTITION BY l2)::BIGINT AS a2 FROM dense)"


def dense_areas(spark, d):
    p = written(dense_pairs(spark, d), "dense")
    a1 = p.groupBy("l1").agg(F.sum("ov").alias("a1"))
    a2 = p.groupBy("l2").agg(F.sum("ov").alias("a2"))
    return p.join(a1, "l1").join(a2, "l2")


@query(f"WITH {DENSE_AREAS} SELECT l1, l2, ov FROM o WHERE {THETA.format(c='>')}")
def j6_theta_match(spark, d):
    o = dense_areas(spark, d)
    return o.where(O.matches_theta(F.col("ov"), F.col("a1"), F.col("a2"), True, 40, 12, 0.9, 0.1)).select("l1", "l2", "ov")


@query(f"WITH {DENSE_AREAS} SELECT l1, l2, ov FROM o WHERE {THETA.format(c='>=')}")
def j7_theta_match_inclusive(spark, d):
    o = dense_areas(spark, d)
    return o.where(O.matches_theta(F.col("ov"), F.col("a1"), F.col("a2"), False, 40, 12, 0.9, 0.1)).select("l1", "l2", "ov")


@query()
def j8_stable_match(spark, d):
    """No SQL: the number of rounds depends on the data. Tests check that no blocking pair is left."""
    return M.stable(dense_pairs(spark, d))


@query()
def j9_polygamous_match(spark, d):
    pairs = dense_pairs(spark, d).withColumn("pair", (F.col("l1") % 4))
    return M.polygamous(pairs, 2)


@query()
def j10_multimatch(spark, d):
    """Block pairs: suppliers by their number modulo 4; areas and the slab's size are those of the pair."""
    o = dense_pairs(spark, d).withColumn("pair", F.col("l1") % 4)
    for own, area in (("l1", "a1"), ("l2", "a2")):
        o = o.join(o.groupBy("pair", own).agg(F.sum("ov").alias(area)), ["pair", own])
    o = o.join(o.groupBy("pair").agg(F.sum("ov").alias("total")), "pair")
    return M.multimatch(o, 2, 0.0001, ("pair",))


@query(f"""WITH {DENSE_AREAS}, b AS (SELECT *, row_number() OVER (PARTITION BY l1 ORDER BY ov DESC, l2) AS r1, row_number() OVER (PARTITION BY l2 ORDER BY ov DESC, l1) AS r2, sum(ov) OVER () AS total FROM o), k AS (SELECT l1, l2 FROM b WHERE ov >= 40)
  SELECT DISTINCT l1, l2 FROM b WHERE ((r1 = 1 AND ov / a1 >= 0.05 AND ov / total >= 0.0001) OR (r2 = 1 AND ov / a2 >= 0.05 AND ov / total >= 0.0001)) AND NOT EXISTS (SELECT 1 FROM k WHERE k.l1 = b.l1 AND k.l2 = b.l2)""")
def j11_orphan_join(spark, d):
    o = written(dense_areas(spark, d), "areas")
    total = o.agg(F.sum("ov")).first()[0] or 1
    return M.orphans(o, o.where("ov >= 40"), total, 0.05, 0.0001)


@query("""WITH g AS (SELECT x::INT AS bx, y::INT AS by, z::INT AS bz, (x + y * 5 + z * 25)::BIGINT AS block FROM range(5) a(x), range(5) b(y), range(2) c(z))
  SELECT 'x' AS axis, (a.bx % 2)::INT AS parity, a.block AS block1, b.block AS block2 FROM g a JOIN g b ON b.bx = a.bx + 1 AND b.by = a.by AND b.bz = a.bz
  UNION ALL SELECT 'y', a.by % 2, a.block, b.block FROM g a JOIN g b ON b.bx = a.bx AND b.by = a.by + 1 AND b.bz = a.bz
  UNION ALL SELECT 'z', a.bz % 2, a.block, b.block FROM g a JOIN g b ON b.bx = a.bx AND b.by = a.by AND b.bz = a.bz + 1""")
def j12_neighbour_blocks(spark, d):
    return V.neighbour_pairs(V.block_grid(spark, (2048, 2048, 116), (384, 384, 52), (64, 64, 6)))


BRIDGE = f"{VOX}, cell AS (SELECT DISTINCT z, label_a AS clique, label_b AS cell FROM vox WHERE label_a > 0), adj AS (SELECT DISTINCT a.z, a.label_b AS c1, b.label_b AS c2 FROM vox a JOIN vox b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x WHERE a.label_b <> b.label_b)"


def bridge(spark, d):
    v = vox(spark, d)
    cell = v.where("label_a > 0").select("z", F.col("label_a").alias("clique"), F.col("label_b").alias("cell")).distinct()
    up = v.select((F.col("z") - 1).alias("z"), "y", "x", F.col("label_b").alias("c2"))
    adj = v.select("z", "y", "x", F.col("label_b").alias("c1")).join(up, ["z", "y", "x"]).where("c1 <> c2").select("z", "c1", "c2").distinct()
    return cell, adj


@query(f"WITH {BRIDGE} SELECT DISTINCT p.z, p.clique AS q1, n.clique AS q2 FROM cell p JOIN adj ON adj.z = p.z AND adj.c1 = p.cell JOIN cell n ON n.z = p.z + 1 AND n.cell = adj.c2")
def j13_matrix_join(spark, d):
    """Cliques of neighbouring planes by way of adjacent cells: two equi-joins and a distinct."""
    cell, adj = bridge(spark, d)
    first = cell.select("z", F.col("clique").alias("q1"), F.col("cell").alias("c1")).join(adj, ["z", "c1"]).select("z", "q1", "c2").distinct()
    after = cell.select((F.col("z") - 1).alias("z"), F.col("clique").alias("q2"), F.col("cell").alias("c2"))
    return first.join(after, ["z", "c2"]).select("z", "q1", "q2").distinct()


@query(f"WITH {BRIDGE} SELECT z, c1, c2 FROM adj")
def j14_vertical_adjacency(spark, d):
    return bridge(spark, d)[1]


@query(f"""WITH {BRIDGE}, n AS (SELECT DISTINCT a.z, a.label_b AS c2, b.label_b AS c3 FROM vox a JOIN vox b ON b.z = a.z AND ((b.y = a.y AND abs(b.x - a.x) = 1) OR (b.x = a.x AND abs(b.y - a.y) = 1)) WHERE a.label_b <> b.label_b)
  SELECT z, c1, c2 FROM adj UNION SELECT adj.z, c1, c3 FROM adj JOIN n ON n.z = adj.z + 1 AND n.c2 = adj.c2 WHERE c1 <> c3""")
def j15_large_displacement(spark, d):
    _, adj = bridge(spark, d)
    v = vox(spark, d)
    plane = neighbours_in_plane(v, "label_b").select((F.col("z") - 1).alias("z"), F.col("a").alias("c2"), F.col("b").alias("c3"))
    far = adj.join(plane, ["z", "c2"]).where("c1 <> c3").select("z", "c1", F.col("c3").alias("c2"))
    return adj.unionByName(far).distinct()


def neighbours_in_plane(v, label):
    """(z, a, b): different labels side by side in a plane, both ways."""
    steps = F.array(*[F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i, j in ((0, 1), (1, 0))])
    own = v.select("z", "y", "x", F.col(label).alias("a"))
    moved = v.withColumn("s", F.explode(steps)).select("z", (F.col("y") - F.col("s.dy")).alias("y"), (F.col("x") - F.col("s.dx")).alias("x"), F.col(label).alias("b"))
    pairs = own.join(moved, ["z", "y", "x"]).where("a <> b").select("z", "a", "b").distinct()
    return pairs.unionByName(pairs.select("z", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


FACES = f"""{VOX}, s AS (SELECT * FROM (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) t(dz, dy, dx)),
  f AS (SELECT a.label_a AS a, b.label_a AS b, a.p AS p FROM vox a, s JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx WHERE a.label_a <> b.label_a AND a.label_a > 0 AND b.label_a > 0)"""


@query(f"WITH {FACES} SELECT a, b, count(*) AS n FROM f GROUP BY ALL")
def j16_voxel_neighbours(spark, d):
    return O.boundary_stats(vox(spark, d), "label_a").select("a", "b", "n")


@query(f"WITH {IMG} SELECT a.y, a.x, dy::INT AS dy, dx::INT AS dx, round(abs(a.v - b.v), 7) AS w FROM img a, (VALUES (0, 1), (1, -1), (1, 0), (1, 1)) s(dy, dx) JOIN img b ON b.y = a.y + dy AND b.x = a.x + dx")
def j17_pixel_edges(spark, d):
    """Edges of the 8-neighbour grid, each once."""
    i = img(spark, d).select("y", "x", "v")
    steps = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (1, -1), (1, 0), (1, 1))])
    moved = i.withColumn("s", F.explode(steps)).select((F.col("y") - F.col("s.dy")).alias("y"), (F.col("x") - F.col("s.dx")).alias("x"), "s.dy", "s.dx", F.col("v").alias("w"))
    return i.join(moved, ["y", "x"]).select("y", "x", "dy", "dx", F.round(F.abs(F.col("v") - F.col("w")), 7).alias("w"))


@query(f"WITH {VOX}, big AS (SELECT label_a FROM vox GROUP BY 1 HAVING count(*) > (SELECT count(*) / 7 FROM vox)) SELECT event_id FROM vox WHERE label_a IN (SELECT label_a FROM big)")
def j18_label_in_set(spark, d):
    v = vox(spark, d)
    big = v.groupBy("label_a").agg(rows().alias("n")).join(F.broadcast(v.agg((rows() / 7).alias("least"))), F.col("n") > F.col("least"))
    return v.join(big, "label_a", "left_semi").select("event_id")


SLICES = f"{VOX}, lab AS (SELECT DISTINCT z, label_a * 10 + label_b AS l FROM vox WHERE p > 40)"


def slice_labels(spark, d):
    return vox(spark, d).where("p > 40").select("z", (F.col("label_a") * 10 + F.col("label_b")).alias("l")).distinct()


@query(f"WITH {SLICES} SELECT z, l FROM lab a WHERE NOT EXISTS (SELECT 1 FROM lab b WHERE b.z = a.z + 1 AND b.l = a.l)")
def j19_absent_in_next(spark, d):
    lab = slice_labels(spark, d)
    return lab.join(lab.select((F.col("z") - 1).alias("z"), "l"), ["z", "l"], "left_anti")


@query("""WITH s(feature, thr, lo, hi) AS (VALUES ('f0', 0.1, -1.0, 1.0), ('f1', 0.0, 0.5, -0.5), ('f2', -0.1, 0.25, 0.75)), f AS (SELECT vec_id, 'f' || (i - 1) AS feature, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 4) t(i))
  SELECT vec_id, round(sum(CASE WHEN v <= thr THEN lo ELSE hi END), 6)::DOUBLE AS score, count(*) AS used FROM f JOIN s USING (feature) GROUP BY vec_id""")
def j20_stump_feature_join(spark, d):
    """Long features joined with the stump table by name; `used` must be the number of stumps."""
    stumps = spark.createDataFrame([("f0", 0.1, -1.0, 1.0), ("f1", 0.0, 0.5, -0.5), ("f2", -0.1, 0.25, 0.75)], "feature string, thr double, lo double, hi double")
    long = table(spark, d, "embeddings").select("vec_id", F.posexplode(F.slice("embedding", 1, 3)).alias("i", "v")).select("vec_id", F.concat(F.lit("f"), F.col("i").cast("string")).alias("feature"), F.col("v").cast("double").alias("v"))
    return long.join(F.broadcast(stumps), "feature").groupBy("vec_id").agg(F.round(F.sum(F.when(F.col("v") <= F.col("thr"), F.col("lo")).otherwise(F.col("hi"))), 6).alias("score"), rows().alias("used"))


@query(f"WITH {IMG}, lab AS (SELECT y, x, (label % 2)::INT AS cls FROM img WHERE (y + x) % 9 = 0) SELECT y, x, cls, round(v, 7) AS v FROM lab JOIN img USING (y, x)")
def j21_training_gather(spark, d):
    i = img(spark, d)
    lab = i.where("(y + x) % 9 = 0").select("y", "x", (F.col("label") % 2).cast("int").alias("cls"))
    return lab.join(i.select("y", "x", "v"), ["y", "x"]).select("y", "x", "cls", F.round("v", 7).alias("v"))


@query("""WITH e AS (SELECT vec_id, [v::DOUBLE for v in embedding] AS e FROM embeddings), c AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(a.e, b.e)]), 9) AS dist FROM e a JOIN e b ON a.vec_id % 10 = 0 AND b.vec_id % 10 <> 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS r, lead(dist) OVER (PARTITION BY a ORDER BY dist, b) AS second FROM c) SELECT a, b, dist FROM r WHERE r = 1 AND 1.01 * dist < second""")
def j22_descriptor_match(spark, d):
    """Nearest neighbour with a ratio test, over all pairs, block by block."""
    e = table(spark, d, "embeddings")
    asked = e.where("vec_id % 10 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("e"))
    return M.nearest(asked, e.where("vec_id % 10 <> 0").select(F.col("vec_id").alias("b"), F.col("embedding").alias("e")), 1.01)


@query(f"WITH {VOX} SELECT label_a AS label, count(*) AS area FROM vox WHERE label_a > 0 GROUP BY 1")
def a1_label_areas(spark, d):
    return O.areas(vox(spark, d), "label_a")


@query(f"WITH {VOX} SELECT label_a AS l1, label_b AS l2, count(*) AS ov FROM vox WHERE label_a > 0 AND label_b > 0 GROUP BY ALL")
def a2_pair_counts(spark, d):
    return O.pair_counts(vox(spark, d), "label_a", "label_b")


@query(f"WITH {DENSE_AREAS} SELECT * FROM o")
def a3_pair_count_totals(spark, d):
    return dense_areas(spark, d)


@query(f"WITH {PAIRS} SELECT src, (dense_rank() OVER (ORDER BY src) - 1)::BIGINT AS new FROM (SELECT DISTINCT src FROM pairgraph)")
def a4_packed_labels(spark, d):
    return O.dense_ids(pairgraph(spark, d), "src", 0)


@query(f"WITH {VOX} SELECT DISTINCT label_a, label_b FROM vox")
def a5_unique(spark, d):
    return vox(spark, d).select("label_a", "label_b").distinct()


@query(f"WITH {VOX} SELECT min(event_id) AS event_id, label_a, label_b FROM vox GROUP BY label_a, label_b")
def a6_first_occurrences(spark, d):
    return vox(spark, d).groupBy("label_a", "label_b").agg(F.min("event_id").alias("event_id"))


@query(f"WITH {SEGS}, s AS (SELECT z, list_sort(list(DISTINCT label)) AS l FROM segs WHERE label > 0 GROUP BY z, y, x HAVING count(DISTINCT label) > 1) SELECT DISTINCT z, array_to_string(l, ',') AS labels FROM s")
def a7_exclusion_sets(spark, d):
    return O.exclusion_sets(segs(spark, d)).select("z", F.concat_ws(",", F.transform("labels", lambda v: v.cast("string"))).alias("labels"))


@query(f"WITH {VOX} SELECT label_a, array_to_string(list_sort(list(DISTINCT label_b)), ',') AS cells FROM vox GROUP BY 1")
def a8_group_to_set(spark, d):
    return vox(spark, d).groupBy("label_a").agg(F.array_sort(F.collect_set("label_b")).alias("c")).select("label_a", F.concat_ws(",", F.transform("c", lambda v: v.cast("string"))).alias("cells"))


@query(f"WITH {PAIRS}, c AS (SELECT dst % 50 AS label, src % 4 AS cell FROM pairgraph GROUP BY ALL), s AS (SELECT label, list_sort(list(cell)) AS l FROM c GROUP BY 1) SELECT label, min(label) OVER (PARTITION BY l) AS kept FROM s")
def a10_condense(spark, d):
    cells = pairgraph(spark, d).select((F.col("dst") % 50).alias("label"), (F.col("src") % 4).alias("cell"))
    return O.condensed(cells)


@query(f"WITH {FACES} SELECT a, b, count(*) AS n, round(sum(p), 4) AS psum, round(sum(p) / count(*), 6) AS mean FROM f GROUP BY ALL")
def a11_boundary_stats(spark, d):
    return O.boundary_stats(vox(spark, d), "label_a").select("a", "b", "n", F.round("psum", 4).alias("psum"), F.round(F.col("psum") / F.col("n"), 6).alias("mean"))


@query(f"WITH {DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY l1 ORDER BY ov DESC, l2) AS r FROM dense) SELECT l1, l2, ov FROM r WHERE r = 1")
def a12_dominant_partner(spark, d):
    return O.dominant(dense_pairs(spark, d), "l1", "l2", "ov")


@query(f"WITH {IMG} SELECT (y // 64)::BIGINT AS tile, least(greatest(floor((v + 1) * 128), 0), 255)::BIGINT AS bin, count(*) AS n FROM img GROUP BY ALL")
def a13_histogram(spark, d):
    b = F.least(F.greatest(F.floor((F.col("v") + 1) * 128), F.lit(0)), F.lit(255)).cast("long")
    return img(spark, d).groupBy(F.floor(F.col("y") / 64).alias("tile"), b.alias("bin")).agg(rows().alias("n"))


@query("""WITH e AS (SELECT vec_id, list_sort([v::DOUBLE for v in embedding[1:8]]) AS s FROM embeddings)
  SELECT vec_id, round(s[1], 7) AS lo, round(s[8], 7) AS hi, round(s[8] - s[1], 7) AS span, round(s[5], 7) AS med, round(list_sum(s) / 8, 7) AS mean, round(list_sum([v * v for v in s]) / 8 - (list_sum(s) / 8) * (list_sum(s) / 8), 7) AS var FROM e""")
def a14_orientation_stats(spark, d):
    """Over 8 responses; the median is the upper one (place n / 2 of the sorted list)."""
    s = F.sort_array(F.transform(F.slice("embedding", 1, 8), lambda v: v.cast("double")))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    e = table(spark, d, "embeddings").select("vec_id", s.alias("s"))
    mean, square = total(F.col("s")) / 8, total(F.transform("s", lambda v: v * v)) / 8
    return e.select("vec_id", F.round(F.col("s")[0], 7).alias("lo"), F.round(F.col("s")[7], 7).alias("hi"), F.round(F.col("s")[7] - F.col("s")[0], 7).alias("span"), F.round(F.col("s")[4], 7).alias("med"), F.round(mean, 7).alias("mean"), F.round(square - mean * mean, 7).alias("var"))


@query(f"WITH {IMG} SELECT (y // 8)::BIGINT AS ty, (x // 8)::BIGINT AS tx, round(avg(v), 6) AS mean, round(var_samp(v), 6) AS var, count(*) FILTER (v < 0) AS below, count(*) FILTER (v >= 0) AS above FROM img GROUP BY ALL")
def a15_window_mean_variance(spark, d):
    return img(spark, d).groupBy(F.floor(F.col("y") / 8).alias("ty"), F.floor(F.col("x") / 8).alias("tx")).agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.var_samp("v"), 6).alias("var"), F.count_if(F.col("v") < 0).alias("below"), F.count_if(F.col("v") >= 0).alias("above"))


@query("""WITH t AS (SELECT vec_id, (embedding[1 + (i * 7) % 64] > 0.0)::INT AS cls FROM embeddings, range(25) r(i)) SELECT vec_id, cls, round(count(*) / 25, 6) AS p FROM t GROUP BY ALL""")
def a17_tree_votes(spark, d):
    e = table(spark, d, "embeddings").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(24))))
    return e.select("vec_id", (F.get("embedding", (F.col("i") * 7) % 64) > 0).cast("int").alias("cls")).groupBy("vec_id", "cls").agg(F.round(rows() / 25, 6).alias("p"))


@query(f"WITH {VOX} SELECT z, label_a, count(*) AS size, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM vox WHERE label_a > 0 GROUP BY ALL")
def a18_clique_stats(spark, d):
    return vox(spark, d).where("label_a > 0").groupBy("z", "label_a").agg(rows().alias("size"), F.round(F.avg("x"), 6).alias("cx"), F.round(F.avg("y"), 6).alias("cy"))


@query(f"WITH {OVERLAPS} SELECT l1, l2, round(ov / a1, 6) AS fwd, round(ov / a2, 6) AS bwd FROM o")
def a19_overlap_ratios(spark, d):
    return overlaps(spark, d).select("l1", "l2", F.round(F.col("ov") / F.col("a1"), 6).alias("fwd"), F.round(F.col("ov") / F.col("a2"), 6).alias("bwd"))


@query(f"WITH {VOX}, c AS (SELECT label_a AS clique, label_b AS cell, count(*) AS area FROM vox WHERE label_a > 0 GROUP BY ALL) SELECT clique, sum(area)::BIGINT AS size, count(*) AS cells FROM c GROUP BY 1")
def a20_clique_internal_size(spark, d):
    c = O.pair_counts(vox(spark, d), "label_a", "label_b")
    return c.groupBy(F.col("l1").alias("clique")).agg(F.sum("ov").alias("size"), rows().alias("cells"))


@query(f"WITH {VOX} SELECT label_a, array_to_string(list_sort(list(DISTINCT (y // 5) * 100 + (x // 5) * 10000 + z)), ',') AS chunks FROM vox WHERE label_a > 0 GROUP BY 1")
def a24_chunk_map(spark, d):
    at = vox(spark, d).where("label_a > 0").select("label_a", (F.floor(F.col("y") / 5) * 100 + F.floor(F.col("x") / 5) * 10000 + F.col("z")).alias("c")).distinct()
    return at.groupBy("label_a").agg(F.array_sort(F.collect_list("c")).alias("c")).select("label_a", F.concat_ws(",", F.transform("c", lambda v: v.cast("string"))).alias("chunks"))


@query("SELECT label AS cls, count(*) AS n, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS prior FROM embeddings GROUP BY 1")
def a27_class_priors(spark, d):
    e = table(spark, d, "embeddings")
    total = e.agg(rows().alias("total"))
    return e.groupBy(F.col("label").alias("cls")).agg(rows().alias("n")).join(F.broadcast(total)).select("cls", "n", F.round(F.col("n") / F.col("total"), 6).alias("prior"))


@query(f"WITH {OVERLAPS}, c AS (SELECT l1, round(ov / greatest(a1, a2), 6) AS cost FROM o) SELECT l1, round(sum(cost), 5) AS total FROM c GROUP BY 1")
def a29_link_cost_total(spark, d):
    return overlaps(spark, d).groupBy("l1").agg(F.round(F.sum(F.round(F.col("ov") / F.greatest("a1", "a2"), 6)), 5).alias("total"))


@query(f"WITH {SEGS} SELECT z, y, x, max(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS is_boundary FROM segs GROUP BY ALL")
def a30_any_projection(spark, d):
    return segs(spark, d).groupBy("z", "y", "x").agg(F.max((F.col("label") == 0).cast("int")).alias("is_boundary"))


@query(f"WITH {DENSE} SELECT l1, l2, ov, row_number() OVER (PARTITION BY l1 ORDER BY ov DESC, l2)::INT AS place FROM dense")
def t1_preference_lists(spark, d):
    return dense_pairs(spark, d).withColumn("place", F.row_number().over(W.partitionBy("l1").orderBy(F.col("ov").desc(), "l2")))


@query(f"WITH {DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY ov DESC, l1) AS r FROM dense) SELECT l2, l1, ov FROM r WHERE r = 1")
def t2_top_partner(spark, d):
    return O.dominant(dense_pairs(spark, d), "l2", "l1", "ov")


@query(f"WITH {VOX}, o AS (SELECT z, label_a AS gt, label_b AS seg, count(*) AS ov FROM vox WHERE label_a > 0 GROUP BY ALL) SELECT z, gt, seg, ov, row_number() OVER (PARTITION BY z, gt ORDER BY ov DESC, seg)::INT AS place FROM o")
def t3_overlaps_largest_first(spark, d):
    o = vox(spark, d).where("label_a > 0").groupBy("z", F.col("label_a").alias("gt"), F.col("label_b").alias("seg")).agg(rows().alias("ov"))
    return o.withColumn("place", F.row_number().over(W.partitionBy("z", "gt").orderBy(F.col("ov").desc(), "seg")))


@query(f"WITH {VOX} SELECT label_a, count(*) AS n, row_number() OVER (ORDER BY count(*), label_a) AS turn FROM vox WHERE label_a > 0 GROUP BY 1")
def t4_smallest_first(spark, d):
    return O.areas(vox(spark, d), "label_a").select(F.col("label").alias("label_a"), F.col("area").alias("n")).transform(lambda o: O.numbered(o, ["n", "label_a"], "turn"))


@query(f"WITH {PAIRS} SELECT src, dst FROM pairgraph ORDER BY src, dst")
def t5_sorted_merges(spark, d):
    return pairgraph(spark, d).select("src", "dst").orderBy("src", "dst")


@query(f"WITH {IMG} SELECT label, x, round(v, 7) AS v FROM img WHERE x < 4")
def t6_bag_sort(spark, d):
    """Bags sorted by a feature within partitions: no global order is needed to find splits."""
    return img(spark, d).where("x < 4").repartition("label").sortWithinPartitions("label", "x", "v").select("label", "x", F.round("v", 7).alias("v"))


@query(f"WITH {IMG}, s AS (SELECT y, list_sort(list(v)) AS s FROM img GROUP BY y) SELECT y, round(s[33], 7) AS med FROM s")
def t7_upper_median(spark, d):
    return img(spark, d).groupBy("y").agg(F.sort_array(F.collect_list("v")).alias("s")).select("y", F.round(F.col("s")[F.floor(F.size("s") / 2).cast("int")], 7).alias("med"))


@query(f"WITH {IMG} SELECT y, x, row_number() OVER (PARTITION BY y ORDER BY v, x)::INT AS place FROM img")
def t9_sort_with_index(spark, d):
    return img(spark, d).select("y", "x", F.row_number().over(W.partitionBy("y").orderBy("v", "x")).alias("place"))


@query(f"WITH {VOX} SELECT label_a AS a, label_b AS b FROM vox WHERE z = 0 UNION ALL SELECT label_a, label_b FROM vox WHERE z = 1")
def u1_union_all(spark, d):
    m = vox(spark, d).select("z", F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    return m.where("z = 0").drop("z").unionByName(m.where("z = 1").drop("z"))


@query(f"WITH {MERGES.split(', e AS')[0]} SELECT a, b FROM m")
def u2_identity_pairs(spark, d):
    return merges(spark, d)


UV = f"{VOX}, u AS (SELECT DISTINCT label_a * 10 + label_b AS l FROM vox WHERE z = 0 AND p > 30), v AS (SELECT DISTINCT label_a * 10 + label_b AS l FROM vox WHERE z = 1 AND p > 30)"


def two_sets(spark, d):
    m = vox(spark, d).where("p > 30").select("z", (F.col("label_a") * 10 + F.col("label_b")).alias("l"))
    return m.where("z = 0").select("l").distinct(), m.where("z = 1").select("l").distinct()


@query(f"WITH {UV} SELECT l FROM u UNION SELECT l FROM v")
def u3_union_distinct(spark, d):
    a, b = two_sets(spark, d)
    return a.union(b).distinct()


@query(f"WITH {UV} SELECT l FROM u INTERSECT SELECT l FROM v")
def u4_intersect(spark, d):
    a, b = two_sets(spark, d)
    return a.intersect(b)


@query(f"WITH {UV} SELECT l FROM u EXCEPT SELECT l FROM v")
def u5_except(spark, d):
    a, b = two_sets(spark, d)
    return a.exceptAll(b)


@query(f"""WITH {VOX}, s AS (SELECT * FROM (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(dy, dx)), n AS (SELECT DISTINCT a.z, a.label_b AS a, b.label_b AS b FROM vox a, s JOIN vox b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx WHERE a.label_b <> b.label_b) SELECT a, b FROM n WHERE z = 0 UNION SELECT a, b FROM n WHERE z = 1""")
def u6_edge_union(spark, d):
    n = neighbours_in_plane(vox(spark, d), "label_b")
    return n.where("z = 0").select("a", "b").union(n.where("z = 1").select("a", "b")).distinct()


@query(f"WITH {VOX}, m AS (SELECT DISTINCT z, label_a AS r, label_b AS c FROM vox) SELECT (z * 6 + r)::BIGINT AS r, (z * 5 + c)::BIGINT AS c FROM m")
def u7_block_diagonal(spark, d):
    m = vox(spark, d).select("z", F.col("label_a").alias("r"), F.col("label_b").alias("c")).distinct()
    return m.select((F.col("z") * 6 + F.col("r")).alias("r"), (F.col("z") * 5 + F.col("c")).alias("c"))


@query(f"WITH RECURSIVE {MERGES} SELECT old::BIGINT AS old, new::BIGINT AS new FROM remap UNION ALL SELECT 0, 0")
def g2_global_map(spark, d):
    return C.global_map(merges(spark, d))


@query(f"WITH RECURSIVE {PAIRS}, e AS (SELECT src + 1 AS u, dst AS v FROM pairgraph UNION SELECT dst, src + 1 FROM pairgraph), r(id, t) AS (SELECT u, v FROM e UNION SELECT r.id, e.v FROM r JOIN e ON r.t = e.u) SELECT id, least(id, min(t)) AS root FROM r GROUP BY id")
def g2_sparse_roots(spark, d):
    return C.roots(pairgraph(spark, d).select((F.col("src") + 1).alias("a"), F.col("dst").alias("b")))
