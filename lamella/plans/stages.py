"""Queries of sources, sinks, regions, fusion, classifiers and extraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import components as C, fusion as FU, image as I, learn as L, overlap as O, regions as R, volume as V
from ..session import scratch, written
from ..sources import readers as RD, writers as WR
from .registry import IMG, VOX, img, query, table, vox


def plane(spark, d, z: int = 0):
    return vox(spark, d).where(F.col("z") == z)


@query("SELECT vec_id::INT AS y, round(embedding[2]::DOUBLE, 7) AS f1 FROM embeddings WHERE vec_id >= 20 AND vec_id < 60")
def s3_feature_region(spark, d):
    """Two columns of a wide feature table in a region; both reach the scan."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("int").alias("y"), F.lit(0).alias("x"), *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(3)])
    return RD.features(e, ["f1"], {"y": (20, 60)}).select("y", F.round("f1", 7).alias("f1"))


@query(f"WITH {IMG} SELECT (max(y) + 1)::INT AS height, (max(x) + 1)::INT AS width FROM img")
def s4_extent(spark, d):
    return RD.extent(img(spark, d))


@query("SELECT i::INT AS i, 'f' || i AS name FROM range(3) t(i)")
def s5_feature_names(spark, d):
    e = table(spark, d, "embeddings").select(F.lit(0).alias("y"), F.lit(0).alias("x"), *[F.col("embedding")[i].alias(f"f{i}") for i in (2, 0, 1)])
    return spark.createDataFrame(list(enumerate(RD.feature_names(e))), "i int, name string")


COLOURS = f"{VOX}, c AS (SELECT z, y, x, (label_a * 41 % 256)::INT AS r, (label_b * 59 % 256)::INT AS g, (event_id % 256)::INT AS b, 7 AS a FROM vox)"


def colours(spark, d):
    return vox(spark, d).select("z", "y", "x", (F.col("label_a") * 41 % 256).cast("int").alias("r"), (F.col("label_b") * 59 % 256).cast("int").alias("g"), (F.col("event_id") % 256).cast("int").alias("b"), F.lit(7).alias("a"))


@query(f"WITH {COLOURS} SELECT z, y, x, (r * 65536 + g * 256 + b + a * 16777216::BIGINT)::BIGINT AS label FROM c")
def s8_colour_stack(spark, d):
    return RD.colour_stack(colours(spark, d), alpha=True)


@query(f"WITH {COLOURS} SELECT z, y, x, 1 AS seg, r = 0 AS is_boundary FROM c")
def s9_import_segmentations(spark, d):
    return RD.external_segmentations(colours(spark, d).withColumn("v", F.col("r")).withColumn("seg", F.lit(1)))


@query(f"""WITH {VOX}, q AS (SELECT 0 AS i, z, y, x, label_a AS v FROM vox WHERE z = 0 UNION ALL SELECT 1, 0, y + 15, x, label_a FROM vox WHERE z = 1 UNION ALL SELECT 2, 0, y, x + 15, label_a FROM vox WHERE z = 2 UNION ALL SELECT 3, 0, y + 15, x + 15, label_a FROM vox WHERE z = 3)
  SELECT z, y, x, max_by(v, i) AS v FROM q GROUP BY ALL""")
def s10_quadrants(spark, d):
    part = lambda z: plane(spark, d, z).select(F.lit(0).alias("z"), "y", "x", F.col("label_a").alias("v"))
    return RD.quadrants([(part(0), 0, 0), (part(1), 15, 0), (part(2), 0, 15), (part(3), 15, 15)])


@query("SELECT p_partkey, row_number() OVER (ORDER BY try_cast(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT), p_partkey)::INT AS z FROM part")
def s11_numeric_stack_order(spark, d):
    from pyspark.sql import Window as W

    key = S.digits_key(F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.row_number().over(W.orderBy(key.asc_nulls_last(), "p_partkey")).alias("z"))


@query(f"WITH {COLOURS}, p AS (SELECT z, y, x, CASE WHEN r < 50 THEN 0 WHEN r < 130 THEN 255 ELSE r END AS r, CASE WHEN r < 50 THEN 255 ELSE 0 END AS g FROM c) SELECT z, y, x, (g = 255 AND r = 0)::INT AS cls FROM p WHERE (g = 255 AND r = 0) OR (r = 255 AND g = 0)")
def s16_painted_labels(spark, d):
    p = colours(spark, d).select("z", "y", "x", F.expr("case when r < 50 then 0 when r < 130 then 255 else r end").alias("r"), F.expr("case when r < 50 then 255 else 0 end").alias("g"), F.lit(0).alias("b"))
    return RD.painted_labels(p)


@query(f"WITH {COLOURS} SELECT z, y, x, CASE WHEN r > g AND r > b THEN 1 WHEN g > r AND g > b THEN 2 ELSE 3 END AS cls FROM c WHERE ((r > g AND r > b) OR (g > r AND g > b) OR (b > r AND b > g))")
def s17_dominant_labels(spark, d):
    return RD.dominant_labels(colours(spark, d))


TILES = f"{VOX}, idx AS (SELECT DISTINCT label_a AS id, 0 AS w, x // 5 AS x, y // 5 AS y, z FROM vox WHERE label_a > 0)"


def tile_index(spark, d):
    return vox(spark, d).where("label_a > 0").select(F.col("label_a").alias("id"), F.lit(0).alias("w"), F.floor(F.col("x") / 5).alias("x"), F.floor(F.col("y") / 5).alias("y"), "z").distinct()


@query(f"WITH {TILES} SELECT w, x, y, z FROM idx WHERE w = 0 AND id = 3 AND z IN (0, 2, 4)")
def s18_tile_index(spark, d):
    return RD.tiles_of(spark, tile_index(spark, d), 0, 3, [0, 2, 4])


@query(f"WITH {TILES} SELECT DISTINCT format('y={{:08d}},x={{:08d}}', y, x) AS name FROM idx WHERE z = 1")
def s19_tile_names(spark, d):
    return tile_index(spark, d).where("z = 1").select(F.format_string("y=%08d,x=%08d", "y", "x").alias("name")).distinct()


@query("SELECT vec_id AS z, round(embedding[1]::DOUBLE, 7) AS p, round(embedding[2]::DOUBLE, 7) AS original, round(embedding[3]::DOUBLE, 7) AS membrane_19_3_0 FROM embeddings")
def k2_probability_sink(spark, d):
    cols = ("p0", "original", "membrane_19_3_0", "unused")
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("z"), F.lit(0).alias("y"), F.lit(0).alias("x"), *[F.round(F.col("embedding")[i].cast("double"), 7).alias(c) for i, c in enumerate(cols)])
    return WR.probabilities(e, "p0").drop("y", "x")


@query(f"WITH {COLOURS} SELECT z, y, x, format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS rgb FROM c")
def k11_overlay(spark, d):
    return WR.overlay(colours(spark, d))


@query(f"WITH {VOX}, t AS (SELECT z, y, x, (x + 3) // 10 AS tile, label_a AS v FROM vox UNION ALL SELECT z, y, x, x // 10, label_b FROM vox) SELECT z, y, x, max_by(v, tile * 100 + v) AS v FROM t GROUP BY ALL")
def k14_reassembled(spark, d):
    """Where tiles overlap the later one stands; equal tiles fall back on the value."""
    v = vox(spark, d)
    a = v.select("z", "y", "x", (F.floor((F.col("x") + 3) / 10) * 100 + F.col("label_a")).alias("tile"), F.col("label_a").alias("v"))
    b = v.select("z", "y", "x", (F.floor(F.col("x") / 10) * 100 + F.col("label_b")).alias("tile"), F.col("label_b").alias("v"))
    return V.reassembled(a.unionByName(b))


MASK = f"RECURSIVE {VOX}, m AS (SELECT z, y, x, event_id + 1 AS pid FROM vox WHERE p > 35), e AS (SELECT a.pid AS u, b.pid AS v FROM m a JOIN m b ON a.z = b.z AND abs(a.y - b.y) + abs(a.x - b.x) <= 1), r(u, t) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.t), c AS (SELECT u, min(t) AS root FROM r GROUP BY u)"


def mask(spark, d):
    return vox(spark, d).where("p > 35").select("z", "y", "x", (F.col("event_id") + 1).alias("pid"))


@query(f"WITH {MASK} SELECT z, y, x, root FROM m JOIN c ON pid = u")
def g1_mask_components(spark, d):
    return R.mask_components(mask(spark, d))


@query(f"WITH {MASK} SELECT z, y, x, root FROM m JOIN c ON pid = u WHERE root IN (SELECT root FROM c GROUP BY 1 HAVING count(*) >= 6)")
def g24_size_filter(spark, d):
    """Components, their sizes, and dust removal."""
    return R.sized(R.mask_components(mask(spark, d)), 6)


def _p(spark, d):
    return vox(spark, d).select("z", "y", "x", (F.least(F.col("p"), F.lit(100.0)) / 100).alias("v"))


@query()
def f9_watershed_sweep(spark, d):
    return R.watershed_sweep(_p(spark, d), [0.1 + 0.1 * i for i in range(5)], 4)


@query()
def g20_watershed(spark, d):
    return R.seeded_growth(_p(spark, d), 0.3, 4)


@query()
def g18_graph_cut(spark, d):
    return R.graph_cuts(_p(spark, d), 0.2, 0.3)


@query()
def g22_inpainting(spark, d):
    return R.inpainted(vox(spark, d).select("z", "y", "x", F.when(F.col("p") > 60, F.col("label_a")).otherwise(0).alias("v")), 3.0)


@query(f"WITH {VOX}, s AS (SELECT * FROM (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) t(dy, dx)) SELECT a.z, a.y, a.x, a.label_a AS label FROM vox a, s LEFT JOIN vox b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx WHERE a.label_a > 0 GROUP BY ALL HAVING count(*) FILTER (b.label_a = a.label_a) < 4")
def r1_contours(spark, d):
    return R.contours(vox(spark, d), "label_a")


@query(f"WITH {VOX}, k AS (SELECT DISTINCT z, y // 5 AS cy, x // 5 AS cx FROM vox WHERE label_a = 3), b AS (SELECT z, y, x FROM vox WHERE label_a = 3) SELECT b.z, b.y, b.x, dense_rank() OVER (ORDER BY b.z DESC)::INT AS depth FROM b JOIN k ON k.z = b.z AND k.cy = y // 5 AND k.cx = x // 5")
def r3_back_to_front(spark, d):
    """Voxels of a label by way of the chunk map, planes from back to front."""
    from pyspark.sql import Window as W

    v = vox(spark, d).withColumn("cy", F.floor(F.col("y") / 5)).withColumn("cx", F.floor(F.col("x") / 5))
    chunks = v.where("label_a = 3").select("z", "cy", "cx").distinct()
    return v.where("label_a = 3").join(chunks, ["z", "cy", "cx"], "left_semi").select("z", "y", "x", F.dense_rank().over(W.orderBy(F.col("z").desc())).alias("depth"))


@query(f"WITH {VOX}, r AS (SELECT z, y, x, CASE WHEN p > 15 THEN label_a ELSE 0 END AS l FROM vox), q AS (SELECT z, y, x, l, coalesce(lag(l) OVER wx, 0) > 0 AND coalesce(lead(l) OVER wx, 0) > 0 AS a, coalesce(lag(l) OVER wy, 0) > 0 AND coalesce(lead(l) OVER wy, 0) > 0 AS b FROM r WINDOW wx AS (PARTITION BY z, y ORDER BY x), wy AS (PARTITION BY z, x ORDER BY y)) SELECT z, y, x FROM q WHERE l = 0 AND (a OR b)")
def g27_cracks(spark, d):
    return R.cracks(vox(spark, d).select("z", "y", "x", F.when(F.col("p") > 15, F.col("label_a")).otherwise(0).alias("label")))


@query(f"WITH {VOX}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM vox) SELECT z, y, x, CASE WHEN x = x0 OR x = x1 OR y = y0 OR y = y1 THEN 1 ELSE 0 END AS frame FROM vox, b")
def g26_frame(spark, d):
    v = vox(spark, d)
    box = v.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return v.join(F.broadcast(box)).select("z", "y", "x", F.expr("cast(x = x0 or x = x1 or y = y0 or y = y1 as int)").alias("frame"))


CLIQUES = f"{VOX}, c AS (SELECT DISTINCT z, label_a AS clique, label_b AS cell FROM vox WHERE label_a > 0 AND p > 70), s AS (SELECT z, clique, list_sort(list(cell)) AS l FROM c GROUP BY ALL)"


@query(f"WITH {CLIQUES} SELECT z, min(clique) AS clique, array_to_string(l, ',') AS cells FROM s GROUP BY z, l")
def g13_cliques(spark, d):
    """Cliques as sets of cells; of equal ones the least stays."""
    c = vox(spark, d).where("label_a > 0 and p > 70").groupBy("z", F.col("label_a").alias("clique")).agg(F.array_sort(F.collect_set("label_b")).alias("l"))
    return c.groupBy("z", "l").agg(F.min("clique").alias("clique")).select("z", "clique", F.concat_ws(",", F.transform("l", lambda v: v.cast("string"))).alias("cells"))


@query(f"WITH {VOX}, o AS (SELECT label_a AS l1, label_b AS l2, count(*) AS ov, count(*) FILTER (x < 2) AS f1, count(*) FILTER (x > 17) AS f2 FROM vox WHERE label_a > 0 GROUP BY ALL) SELECT l1, l2, CASE WHEN ov > 330 THEN 'join' WHEN f1 >= f2 THEN 'first' ELSE 'second' END AS takes FROM o")
def g17_overlap_owner(spark, d):
    """An overlap that isn't joined goes to the side with the larger face."""
    o = vox(spark, d).where("label_a > 0").groupBy(F.col("label_a").alias("l1"), F.col("label_b").alias("l2")).agg(F.count(F.lit(1)).alias("ov"), F.count_if(F.col("x") < 2).alias("f1"), F.count_if(F.col("x") > 17).alias("f2"))
    return o.select("l1", "l2", F.when(F.col("ov") > 330, "join").when(F.col("f1") >= F.col("f2"), "first").otherwise("second").alias("takes"))


#: Planes of a fusion block: as its links stay inside, no object through the whole stack meets in one task.
DEPTH = 3


def _candidates(spark, d):
    """Two candidates a plane: labels, and labels merged by twos; ids unique over planes and candidates."""
    v = vox(spark, d).where("label_a > 0")
    one = v.select("z", "y", "x", (F.col("z") * 100 + F.col("label_a")).cast("long").alias("label"))
    two = v.select("z", "y", "x", (F.col("z") * 100 + 50 + F.floor((F.col("label_a") + 1) / 2)).cast("long").alias("label"))
    return one.unionByName(two)


def _fusion(spark, d):
    c = _candidates(spark, d)
    area = O.areas(c, "label")
    segments = area.select("label", "area", S.segment_worth(F.col("area")).alias("worth"))
    at = c.groupBy("z", "y", "x").agg(F.array_sort(F.collect_set("label")).alias("labels")).where(F.size("labels") > 1).select("labels").distinct()
    sets = at.select((F.col("labels")[0] * 1000000 + F.col("labels")[1]).alias("set"), F.explode("labels").alias("label"))
    links = O.links(c, "label", 1).join(area.select(F.col("label").alias("l1"), F.col("area").alias("a1")), "l1").join(area.select(F.col("label").alias("l2"), F.col("area").alias("a2")), "l2")
    block = lambda c: F.floor(F.col(c) / (100 * DEPTH))
    links = links.where("ov > 0.3 * a1").where(block("l1") == block("l2"))
    return c, segments, sets, links.select("l1", "l2", S.link_worth(F.col("a1"), F.col("a2"), F.col("ov"), F.col("dz")).alias("worth"), S.link_worth_with_segments(F.col("a1"), F.col("a2"), F.col("ov")).alias("alone"))


def _stored_fusion(spark, d):
    """The fusion's tables written, for what reads them several times; the candidates are not."""
    c, segments, sets, links = _fusion(spark, d)
    return c, written(segments, "segments"), written(sets, "sets"), written(links, "links")


FUSION = f"""{VOX}, single AS (SELECT z, y, x, z * 100 + label_a AS a, z * 100 + 50 + (label_a + 1) // 2 AS b FROM vox WHERE label_a > 0),
  cand AS (SELECT z, y, x, a AS label FROM single UNION ALL SELECT z, y, x, b FROM single), area AS (SELECT label, count(*) AS area FROM cand GROUP BY 1),
  pairs AS (SELECT DISTINCT least(a, b) * 1000000 + greatest(a, b) AS set, a, b FROM single), sets AS (SELECT set, a AS label FROM pairs UNION ALL SELECT set, b FROM pairs),
  ov AS (SELECT p.label AS l1, q.label AS l2, count(*) AS ov FROM cand p JOIN cand q ON q.z = p.z + 1 AND q.y = p.y AND q.x = p.x WHERE p.label // 300 = q.label // 300 GROUP BY ALL),
  links AS (SELECT l1, l2, ov, m.area AS a1, n.area AS a2, 'l_' || l1 || '_' || l2 AS name FROM ov JOIN area m ON m.label = l1 JOIN area n ON n.label = l2 WHERE ov > 0.3 * m.area)"""


@query()
def m1_fusion(spark, d):
    """Candidates, exclusions and links to a best selection, block by block; tests compare with all subsets."""
    c, segments, sets, links = _stored_fusion(spark, d)
    return FU.fused(c, written(FU.solved(segments, sets, links), "solution"), links)


@query(f"""WITH {FUSION} SELECT 's' || label AS name, 0.0::DOUBLE AS cost FROM area
  UNION ALL SELECT name, round(ov / greatest(a1, a2) * pow(least(a1, a2), 0.9) + (pow(a1, 0.9) + pow(a2, 0.9)) / 2, 6) FROM links""")
def m2_links_objective(spark, d):
    """The links-only objective: segments are worth what their links bring."""
    _, segments, sets, links = _fusion(spark, d)
    objective, _ = FU.problem(*FU.links_only(segments, sets, links.withColumn("worth", F.col("alone"))))
    return objective.select("name", F.round("cost", 6).alias("cost"))


@query(f"WITH {FUSION} SELECT DISTINCT a.set, least(a.label, b.label) AS a, greatest(a.label, b.label) AS b FROM sets a JOIN sets b ON a.set = b.set AND a.label < b.label")
def m2_pairwise_exclusions(spark, d):
    return FU.pairwise(_fusion(spark, d)[2])


@query(f"""WITH {FUSION} SELECT 'x' || set AS row, 's' || label AS name, 1.0::DOUBLE AS coef, '<=' AS sense, 1.0::DOUBLE AS rhs FROM sets
  UNION ALL SELECT 'u' || l1, name, -1.0, '>=', 0.0 FROM links UNION ALL SELECT DISTINCT 'u' || l1, 's' || l1, 1.0, '>=', 0.0 FROM links
  UNION ALL SELECT 'd' || l2, name, -1.0, '>=', 0.0 FROM links UNION ALL SELECT DISTINCT 'd' || l2, 's' || l2, 1.0, '>=', 0.0 FROM links""")
def m3_problem_rows(spark, d):
    _, segments, sets, links = _fusion(spark, d)
    return FU.problem(segments, sets, links)[1]


@query(f"""WITH {FUSION} SELECT 'u' || l1 AS row, name, 1.0::DOUBLE AS coef, '<=' AS sense, 0.0::DOUBLE AS rhs FROM links UNION ALL SELECT 'u' || l1, 's' || l1, -least(count(*), 2), '<=', 0.0 FROM links GROUP BY l1
  UNION ALL SELECT 'd' || l2, name, 1.0, '<=', 0.0 FROM links UNION ALL SELECT 'd' || l2, 's' || l2, -least(count(*), 2), '<=', 0.0 FROM links GROUP BY l2""")
def m4_branching_rows(spark, d):
    return FU.branching_rows(_fusion(spark, d)[3], 2)


@query(f"""WITH {FUSION} SELECT 'z' || l1 AS row, name, a2::DOUBLE AS coef, '>=' AS sense, 0.0::DOUBLE AS rhs FROM links
  UNION ALL SELECT DISTINCT 'z' || l1, 's' || l1, -(a1 - 5.0)::DOUBLE, '>=', 0.0 FROM links""")
def m5_label_loss_rows(spark, d):
    _, segments, _, links = _fusion(spark, d)
    return FU.label_loss_rows(segments, links, 5.0)


@query("""WITH t(tree, f1, t1, f2, t2) AS (VALUES (1, 1, 0.0, 2, 0.1), (2, 3, -0.05, 4, 0.0), (3, 5, 0.02, 6, -0.02)), v AS (SELECT vec_id AS id, CASE WHEN embedding[f1]::DOUBLE <= t1 THEN 1 WHEN embedding[f2]::DOUBLE <= t2 THEN 2 ELSE 1 END AS cls FROM embeddings, t)
  SELECT id, cls, round(count(*) / 3, 6) AS p FROM v GROUP BY ALL""")
def f14_forest_votes(spark, d):
    nodes = []
    for tree, f1, t1, f2, t2 in ((1, 1, 0.0, 2, 0.1), (2, 3, -0.05, 4, 0.0), (3, 5, 0.02, 6, -0.02)):
        nodes += [(tree, 1, 1, f1, t1, 2, 3, 0), (tree, 2, -1, 0, 0.0, 0, 0, 1), (tree, 3, 1, f2, t2, 4, 5, 0), (tree, 4, -1, 0, 0.0, 0, 0, 2), (tree, 5, -1, 0, 0.0, 0, 0, 1)]
    forest = spark.createDataFrame(nodes, "tree int, node int, status int, feature int, thr double, left int, right int, cls int")
    samples = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("f"))
    return L.forest_votes(samples, forest, depth=3).select("id", "cls", F.round("p", 6).alias("p"))


def _samples(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("f"), (F.col("label") % 2).cast("int").alias("cls"), F.col("embedding")[20].cast("double").alias("t"))


def _stored_samples(spark, d):
    """The samples as a written table: the learners and the prediction read it, and no plan grows with their rounds."""
    return written(_samples(spark, d), "samples")


@query()
def f10_boosted_stumps(spark, d):
    s = _stored_samples(spark, d)
    return L.predicted(L.train_boosting(s, rounds=5), s)


@query()
def f12_random_forest(spark, d):
    s = _stored_samples(spark, d)
    return L.predicted(L.train_forest(s, trees=8, depth=5), s)


@query()
def f16_forest_regression(spark, d):
    s = _stored_samples(spark, d)
    return L.predicted(L.train_regression(s, "t", trees=8, depth=5), s)


def _small(spark, d):
    """All rows of the image, as a stack of planes of 64 rows."""
    return img(spark, d).select(F.floor(F.col("y") / 64).cast("int").alias("z"), (F.col("y") % 64).alias("y"), "x", "v")


@query()
def f3_membrane_response(spark, d):
    return L.membrane_response(_small(spark, d), 9, 3, 4, 32)


@query()
def f4_vesicle_response(spark, d):
    return L.vesicle_response(_small(spark, d), (2, 3), 32)


@query()
def f20_network_ensemble(spark, d):
    """Two small networks with fixed weights over tiles with halos, averaged."""
    nets = []
    for seed in (1, 2):
        rng = np.random.default_rng(seed)
        layers = [(rng.normal(size=(3, 1, 3, 3)) / 3, rng.normal(size=3)), (rng.normal(size=(2, 3, 3, 3)) / 5, rng.normal(size=2))]
        nets.append(L.network(_small(spark, d), layers, (rng.normal(size=(2, 2)), np.zeros(2)), 32))
    return L.ensemble(nets)


@query(f"WITH {VOX} SELECT z, (y // 4)::BIGINT AS cy, (x // 4)::BIGINT AS cx, max(CASE WHEN label_a = 3 THEN 1 ELSE 0 END) AS present FROM vox GROUP BY ALL")
def f25_clique_bitmaps(spark, d):
    return vox(spark, d).groupBy("z", F.floor(F.col("y") / 4).alias("cy"), F.floor(F.col("x") / 4).alias("cx")).agg(F.max((F.col("label_a") == 3).cast("int")).alias("present"))


@query(f"""WITH {MASK}, q AS (SELECT m.*, root FROM m JOIN c ON pid = u) SELECT a.root, count(*) - count(w.root) - count(n.root) + count(CASE WHEN w.root IS NOT NULL AND n.root IS NOT NULL THEN d.root END) AS euler
  FROM q a LEFT JOIN q w ON w.z = a.z AND w.y = a.y AND w.x = a.x - 1 AND w.root = a.root LEFT JOIN q n ON n.z = a.z AND n.y = a.y - 1 AND n.x = a.x AND n.root = a.root LEFT JOIN q d ON d.z = a.z AND d.y = a.y - 1 AND d.x = a.x - 1 AND d.root = a.root GROUP BY 1""")
def g12_euler_numbers(spark, d):
    return R.euler_numbers(R.mask_components(mask(spark, d)))


@query(f"WITH {IMG}, i AS (SELECT y // 64 AS z, (y % 64)::INT AS y, x, v FROM img) SELECT a.z, a.y, a.x, round(a.v, 7) AS v FROM i a JOIN i b ON b.z = a.z AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY a.z, a.y, a.x, a.v HAVING max(b.v) < a.v")
def w17_local_maxima(spark, d):
    return R.local_maxima(_small(spark, d), by=("z",)).select("z", "y", "x", F.round("v", 7).alias("v"))


@query(f"WITH {IMG}, i AS (SELECT y // 64 AS z, (y % 64)::INT AS y, x, v FROM img) SELECT a.z, a.y, a.x, round(a.v, 7) AS v FROM i a JOIN i b ON b.z = a.z AND b.y BETWEEN a.y - 2 AND a.y + 2 AND b.x BETWEEN a.x - 2 AND a.x + 2 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY a.z, a.y, a.x, a.v HAVING min(b.v) > a.v")
def w12_regional_minima(spark, d):
    return R.local_maxima(_small(spark, d), 2, smallest=True, by=("z",)).select("z", "y", "x", F.round("v", 7).alias("v"))


@query(f"WITH {VOX}, q AS (SELECT z, y, x, 2 * (least(p, 100) / 100 - 0.3) AS d, 0.1 * ((lag(x) OVER wx IS NOT NULL)::INT + (lead(x) OVER wx IS NOT NULL)::INT + (lag(y) OVER wy IS NOT NULL)::INT + (lead(y) OVER wy IS NOT NULL)::INT) AS l FROM vox WINDOW wx AS (PARTITION BY z, y ORDER BY x), wy AS (PARTITION BY z, x ORDER BY y)) SELECT z, y, x, CASE WHEN d > l THEN 1 WHEN -d > l THEN 0 END AS fixed FROM q")
def g19_saturated_nodes(spark, d):
    return R.saturated(_p(spark, d), 0.1, 0.3)


@query()
def g23_thinned(spark, d):
    """Labels grow over thin boundaries and into the background."""
    return R.grown(vox(spark, d).select("z", "y", "x", F.when(F.col("p") > 40, F.col("label_a")).otherwise(0).alias("v")))


@query()
def g21_region_growing(spark, d):
    v = vox(spark, d)
    a, b = (v.select("z", "y", "x", F.col(c).alias("label")) for c in ("label_a", "label_b"))
    return R.reconciled(a, b, O.aligned(a, b).where("ov > 25").select("l1", "l2"))


@query()
def w18_bilateral(spark, d):
    return R.bilateral(_p(spark, d), 1.5, 0.2, 3)


@query(f"WITH {VOX} SELECT DISTINCT (label_a * 1000 + z)::BIGINT AS clique, (label_b * 1000 + z)::BIGINT AS cell FROM vox WHERE label_a > 0")
def g15_cube_matrix(spark, d):
    """Cliques and cells of a cube, numbered over its planes."""
    return vox(spark, d).where("label_a > 0").select((F.col("label_a") * 1000 + F.col("z")).alias("clique"), (F.col("label_b") * 1000 + F.col("z")).alias("cell")).distinct()


@query()
def m6_diversified_solutions(spark, d):
    _, segments, sets, links = _stored_fusion(spark, d)
    return FU.diversified(segments, sets, links)


CHAINS = "p AS (SELECT o_custkey AS hi, min(o_orderkey % nullif(o_custkey, 0)) AS lo FROM orders WHERE o_orderkey % nullif(o_custkey, 0) > 0 GROUP BY 1)"


@query(f"WITH RECURSIVE {CHAINS}, r(id, root) AS (SELECT hi, lo FROM p UNION ALL SELECT r.id, p.lo FROM r JOIN p ON p.hi = r.root) SELECT id, min(root) AS root FROM r GROUP BY 1")
def g4_chain_resolution(spark, d):
    o = table(spark, d, "orders")
    return C.chains(o.select(F.col("o_custkey").alias("hi"), F.try_mod("o_orderkey", "o_custkey").alias("lo")))


def _deciles():
    k = I.kernel(1.5, 4)
    weights = ", ".join(f"({j}, {w!r}::DOUBLE)" for j, w in zip(range(-4, 5), k))
    at = lambda c, last: f"(CASE WHEN a.{c} + k < 0 THEN -(a.{c} + k) WHEN a.{c} + k > {last} THEN 2 * {last} - (a.{c} + k) ELSE a.{c} + k END)"
    masks = ", ".join(f"(v >= {i / 10} AND v < {(i + 1) / 10})::INT AS h{i}" for i in range(10))
    sums = ", ".join(f"sum(w * b.h{i}) AS h{i}" for i in range(10))
    out = ", ".join(f"round(h{i}, 6) AS h{i}" for i in range(10))
    return f"""WITH {IMG}, t(k, w) AS (VALUES {weights}), m AS (SELECT y // 64 AS z, (y % 64)::INT AS y, x, max(y % 64) OVER (PARTITION BY y // 64) AS ly, {masks} FROM (SELECT y, x, (v + 1) / 2 AS v FROM img)),
  p AS (SELECT a.z, a.y, a.x, a.ly, {sums} FROM m a, t JOIN m b ON b.z = a.z AND b.y = a.y AND b.x = {at("x", "63")} GROUP BY ALL),
  q AS (SELECT a.z, a.y, a.x, {sums} FROM p a, t JOIN p b ON b.z = a.z AND b.x = a.x AND b.y = {at("y", "a.ly")} GROUP BY ALL) SELECT z, y, x, {out} FROM q"""


@query(_deciles())
def a16_smoothed_decile_counts(spark, d):
    image = _small(spark, d).withColumn("v", (F.col("v") + 1) / 2)
    return I.decile_counts(image, 1.5, 4, ("z",)).select("z", "y", "x", *[F.round(f"h{i}", 6).alias(f"h{i}") for i in range(10)])


BLANK = f"""RECURSIVE {VOX}, m AS (SELECT z, y, x, event_id + 1 AS pid, p <= 35 AS zero FROM vox), e AS (SELECT a.pid AS u, b.pid AS v FROM m a JOIN m b ON a.z = b.z AND a.zero = b.zero AND abs(a.y - b.y) + abs(a.x - b.x) <= 1),
  r(u, t) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.t), c AS (SELECT u, min(t) AS root FROM r GROUP BY u), n AS (SELECT root, count(*) AS n FROM c GROUP BY 1), s AS (SELECT m.*, n FROM m JOIN c ON pid = u JOIN n USING (root)),
  b AS (SELECT z, y, x, pid, zero AND n > 12 AS blank FROM s), e2 AS (SELECT a.pid AS u, b.pid AS v FROM b a JOIN b b ON a.z = b.z AND NOT a.blank AND NOT b.blank AND abs(a.y - b.y) + abs(a.x - b.x) <= 1),
  r2(u, t) AS (SELECT u, v FROM e2 UNION SELECT r2.u, e2.v FROM r2 JOIN e2 ON e2.u = r2.t), c2 AS (SELECT u, min(t) AS root FROM r2 GROUP BY u), n2 AS (SELECT root, count(*) AS n FROM c2 GROUP BY 1)"""


@query(f"WITH {BLANK} SELECT z, y, x, CASE WHEN blank OR n2.n < 6 THEN 1 ELSE 0 END AS blank FROM b LEFT JOIN c2 ON pid = u LEFT JOIN n2 USING (root)")
def p39_blank_regions(spark, d):
    """Values up to 35 stand for zero intensity."""
    v = vox(spark, d).select("z", "y", "x", (F.col("event_id") + 1).alias("pid"), F.when(F.col("p") <= 35, 0).otherwise(F.col("p")).alias("v"))
    return R.blank_regions(v, 12, 6)


@query(f"WITH {FUSION} SELECT z, y, x, (label // 100)::BIGINT AS seglabel, label FROM cand WHERE label % 100 < 50")
def k5_fused_sink(spark, d):
    """Labels of segments and of objects side by side, written as one table and read again."""
    c = _candidates(spark, d).where("label % 100 < 50")
    fused = c.withColumn("seglabel", F.floor(F.col("label") / 100))
    return WR.commit(WR.fused(fused, "seglabel", "label"), f"{scratch(spark, 'fused')}")


@query(f"WITH {VOX}, pair AS (SELECT label_a AS a, label_b + 100 AS b, count(*) AS ov FROM vox WHERE label_a > 0 GROUP BY ALL) SELECT a, b FROM pair WHERE ov > 20 UNION ALL SELECT a, b FROM pair WHERE ov > 30")
def k6_matched_pair_sink(spark, d):
    """Two block pairs, one after the other, append to one merge table."""
    v = vox(spark, d).where("label_a > 0")
    pair = v.groupBy(F.col("label_a").alias("a"), (F.col("label_b") + 100).alias("b")).agg(F.count(F.lit(1)).alias("ov"))
    folder = scratch(spark, "pairs")
    for number, least in enumerate((20, 30)):
        WR.matched_pair(v.select("z", "y", "x", F.col("label_a").alias("label")), v.select("z", "y", "x", (F.col("label_b") + 100).alias("label")), pair.where(F.col("ov") > least).select("a", "b"), folder, number)
    return WR.merge_table(spark, folder)


@query(f"WITH {VOX} SELECT z, list(label_a ORDER BY y, x)::VARCHAR AS row FROM vox GROUP BY z")
def k12_compressed_stack(spark, d):
    """Planes as runs of equal labels, written, read and unpacked."""
    path = scratch(spark, "stack")
    WR.commit(WR.compressed(vox(spark, d), "label_a"), path)
    back = RD.expanded(spark.read.parquet(path))
    row = F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "label"))), lambda t: t["label"].cast("string"))
    return back.groupBy("z").agg(F.concat(F.lit("["), F.array_join(row, ", "), F.lit("]")).alias("row"))
