"""Queries of projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import scalars as S
from ..operators import volume as V
from .registry import IMG, VOX, img, query, table, vox

SIZE, CORE, HALO = {"x": 20, "y": 20}, {"x": 8, "y": 8}, {"x": 2, "y": 2}


@query(f"WITH {VOX} SELECT z, y, x, label_a FROM vox WHERE x >= 4 AND x < 12 AND y >= 3 AND y < 15")
def p1_box_crop(spark, d):
    return V.crop(vox(spark, d), x=(4, 12), y=(3, 15)).select("z", "y", "x", "label_a")


@query(f"""WITH {VOX}, b AS (SELECT unnest([0, 1]) AS i), t AS (
  SELECT z, y, x, bx.i::INT AS bx, by_.i::INT AS by, label_a FROM vox JOIN b bx ON x >= bx.i * 8 + CASE WHEN bx.i > 0 THEN 2 ELSE 0 END AND x < bx.i * 8 + 12 - CASE WHEN bx.i < 1 THEN 2 ELSE 0 END
  JOIN b by_ ON y >= by_.i * 8 + CASE WHEN by_.i > 0 THEN 2 ELSE 0 END AND y < by_.i * 8 + 12 - CASE WHEN by_.i < 1 THEN 2 ELSE 0 END) SELECT * FROM t""")
def p2_halo_trim(spark, d):
    return V.halo_trimmed(V.diced(vox(spark, d), SIZE, CORE, HALO), SIZE, CORE, HALO).select("z", "y", "x", "bx", "by", "label_a")


@query(f"WITH {VOX} SELECT z, y, (x - 8)::INT AS x1, (x - 8)::INT AS x2, label_a FROM vox WHERE x >= 8 AND x < 12")
def p3_overlap_slab(spark, d):
    """Block 0 ends at 12, block 1 begins at 8: the last 2 halo planes of one are the first of the other."""
    blocks = V.diced(vox(spark, d), {"x": 20}, {"x": 8}, {"x": 2})
    one = blocks.where("bx = 0 and x >= 12 - 4").select("z", "y", (F.col("x") - 8).alias("x1"), "label_a", F.col("x").alias("w"))
    two = blocks.where("bx = 1 and x - 8 < 4").select(F.col("z").alias("z2"), F.col("y").alias("y2"), (F.col("x") - 8).alias("x2"), F.col("x").alias("w2"))
    return one.join(two, (F.col("z") == F.col("z2")) & (F.col("y") == F.col("y2")) & (F.col("w") == F.col("w2"))).select("z", "y", "x1", "x2", "label_a")


@query(f"WITH {VOX} SELECT z, y, label_a FROM vox WHERE x = 10")
def p4_single_plane_slab(spark, d):
    return V.crop(vox(spark, d), x=(12 - 2, 12 - 1)).select("z", "y", "label_a")


@query(f"WITH {VOX} SELECT z, y, x, label_a FROM vox WHERE x >= 8 + 2 - 1 AND x < 8 + 2 - 1 + 3")
def p5_match_nslices(spark, d):
    n, halo = 3, 2
    low = 8 + halo - n // 2
    return V.crop(vox(spark, d), x=(low, low + n)).select("z", "y", "x", "label_a")


@query(f"""WITH {VOX}, f AS (SELECT z, y, x, label_a, min(x) OVER () AS x0, max(x) OVER () AS x1, min(y) OVER () AS y0, max(y) OVER () AS y1, min(z) OVER () AS z0, max(z) OVER () AS z1 FROM vox)
  SELECT side, z, y, x, CASE side WHEN 'left' THEN CASE WHEN x = x0 THEN 2 WHEN x = x0 + 3 THEN 1 ELSE 0 END WHEN 'right' THEN CASE WHEN x = x1 - 3 THEN 1 WHEN x = x1 THEN 2 ELSE 0 END
    WHEN 'back' THEN CASE WHEN y = y0 THEN 2 WHEN y = y0 + 3 THEN 1 ELSE 0 END WHEN 'front' THEN CASE WHEN y = y1 - 3 THEN 1 WHEN y = y1 THEN 2 ELSE 0 END
    WHEN 'up' THEN CASE WHEN z = z0 THEN 2 WHEN z = z0 + 1 THEN 1 ELSE 0 END ELSE CASE WHEN z = z1 - 1 THEN 1 WHEN z = z1 THEN 2 ELSE 0 END END AS edge
  FROM f, (VALUES ('left'), ('right'), ('back'), ('front'), ('up'), ('down')) s(side)
  WHERE CASE side WHEN 'left' THEN x <= x0 + 3 WHEN 'right' THEN x >= x1 - 3 WHEN 'back' THEN y <= y0 + 3 WHEN 'front' THEN y >= y1 - 3 WHEN 'up' THEN z <= z0 + 1 ELSE z >= z1 - 1 END""")
def p6_cube_faces(spark, d):
    """The six faces that a cube shares with its neighbours; each face's inner plane is marked 1, its outer one 2."""
    v = vox(spark, d)
    b = v.agg(*[f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))]).first().asDict()
    out = None
    for side, c, outer, inner in (("left", "x", b["x0"], b["x0"] + 3), ("right", "x", b["x1"], b["x1"] - 3), ("back", "y", b["y0"], b["y0"] + 3), ("front", "y", b["y1"], b["y1"] - 3), ("up", "z", b["z0"], b["z0"] + 1), ("down", "z", b["z1"], b["z1"] - 1)):
        face = v.where(F.col(c).between(min(outer, inner), max(outer, inner)))
        if side in ("left", "back", "up"):
            edge = F.when(F.col(c) == outer, 2).when(F.col(c) == inner, 1).otherwise(0)
        else:
            edge = F.when(F.col(c) == inner, 1).when(F.col(c) == outer, 2).otherwise(0)
        face = face.select(F.lit(side).alias("side"), "z", "y", "x", edge.alias("edge"))
        out = face if out is None else out.unionByName(face)
    return out


@query("SELECT greatest(s - 64, 0)::INT AS lo, least(s - 64 + 384 + 128, 2047)::INT AS hi FROM range(0, 2048, 384) t(s)")
def p7_dice_bounds(spark, d):
    return V.dice_bounds(spark, 2048, 384, 64)


@query("""SELECT (x + y * 5 + z * 25)::BIGINT AS block, x::INT AS bx, y::INT AS by, z::INT AS bz, (x * 384)::INT AS xlo, (x * 384 + 512)::INT AS xhi, (y * 384)::INT AS ylo, (y * 384 + 512)::INT AS yhi, (z * 52)::INT AS zlo, (z * 52 + 64)::INT AS zhi
  FROM range(5) a(x), range(5) b(y), range(2) c(z)""")
def p8_block_grid(spark, d):
    return V.block_grid(spark, (2048, 2048, 116), (384, 384, 52), (64, 64, 6))


@query("SELECT x::INT AS bx, y::INT AS by, z::INT AS bz, (x + y * 7 + z * 35)::BIGINT AS block FROM range(7) a(x), range(5) b(y), range(3) c(z)")
def p9_block_id(spark, d):
    i = F.col("id")
    grid = spark.range(105).select((i % 7).cast("int").alias("bx"), (F.floor(i / 7) % 5).cast("int").alias("by"), F.floor(i / 35).cast("int").alias("bz"))
    return grid.withColumn("block", S.block_id(F.col("bx"), F.col("by"), F.col("bz"), 7, 5).cast("long"))


@query(f"WITH {VOX}, p AS (SELECT DISTINCT z FROM vox) SELECT z, least(z // 5, 3)::INT AS slab, (z - 5 * least(z // 5, 3))::INT AS off FROM p")
def p10_plane_slab(spark, d):
    slab, off = V.plane_slab(F.col("z"), 5, 3)
    return vox(spark, d).select("z").distinct().select("z", slab.alias("slab"), off.alias("off"))


@query(f"WITH {VOX} SELECT event_id, CASE WHEN label_a > 0 THEN ((z::BIGINT << 32) | label_a) ELSE 0 END::BIGINT AS id FROM vox")
def p11_packed_ids(spark, d):
    return vox(spark, d).select("event_id", S.packed_id(F.col("label_a"), F.col("z")).alias("id"))


@query(f"WITH {VOX}, p AS (SELECT ((label_a << 32) | label_b)::BIGINT AS pair, count(*) AS n FROM vox GROUP BY 1) SELECT pair, (pair >> 32)::BIGINT AS a, (pair & 4294967295)::BIGINT AS b, n FROM p")
def p12_pair_packing(spark, d):
    pairs = vox(spark, d).groupBy(S.pair_id(F.col("label_a"), F.col("label_b")).alias("pair")).agg(F.count(F.lit(1)).alias("n"))
    a, b = S.unpacked_pair(F.col("pair"))
    return pairs.select("pair", a.alias("a"), b.alias("b"), "n")


OVERLAPS = f"""{VOX}, ov AS (SELECT label_a AS l1, label_b AS l2, count(*) AS ov FROM vox WHERE label_a > 0 AND label_b > 0 GROUP BY ALL),
  a1 AS (SELECT label_a AS l1, count(*) AS a1 FROM vox GROUP BY 1), a2 AS (SELECT label_b AS l2, count(*) AS a2 FROM vox GROUP BY 1), o AS (SELECT * FROM ov JOIN a1 USING (l1) JOIN a2 USING (l2))"""


def overlaps(spark, d):
    """(l1, l2, ov, a1, a2) of the two labellings."""
    v = vox(spark, d)
    ov = v.where("label_a > 0 and label_b > 0").groupBy(F.col("label_a").alias("l1"), F.col("label_b").alias("l2")).agg(F.count(F.lit(1)).alias("ov"))
    a1 = v.groupBy(F.col("label_a").alias("l1")).agg(F.count(F.lit(1)).alias("a1"))
    a2 = v.groupBy(F.col("label_b").alias("l2")).agg(F.count(F.lit(1)).alias("a2"))
    return ov.join(a1, "l1").join(a2, "l2")


@query(f"WITH {OVERLAPS} SELECT l1, round(pow(a1, 0.9), 6) AS worth FROM a1")
def p13_segment_worth(spark, d):
    return vox(spark, d).groupBy(F.col("label_a").alias("l1")).agg(F.round(S.segment_worth(F.count(F.lit(1))), 6).alias("worth"))


@query(f"WITH {OVERLAPS} SELECT l1, l2, dz::INT AS dz, round(ov / greatest(a1, a2) * pow(least(a1, a2), 0.9) * pow(0.75, dz - 1), 6) AS worth FROM o, range(1, 4) t(dz)")
def p14_link_worth(spark, d):
    o = overlaps(spark, d).withColumn("dz", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return o.select("l1", "l2", "dz", F.round(S.link_worth(F.col("a1"), F.col("a2"), F.col("ov"), F.col("dz")), 6).alias("worth"))


@query(f"WITH {OVERLAPS} SELECT l1, l2, round(ov / greatest(a1, a2) * pow(least(a1, a2), 0.9), 6) AS worth FROM o")
def p15_link_worth_flat(spark, d):
    return overlaps(spark, d).select("l1", "l2", F.round(S.link_worth(F.col("a1"), F.col("a2"), F.col("ov")), 6).alias("worth"))


@query(f"WITH {OVERLAPS} SELECT l1, l2, round(ov / greatest(a1, a2) * pow(least(a1, a2), 0.9) + (pow(a1, 0.9) + pow(a2, 0.9)) / 2, 6) AS worth FROM o")
def p16_link_worth_segments(spark, d):
    return overlaps(spark, d).select("l1", "l2", F.round(S.link_worth_with_segments(F.col("a1"), F.col("a2"), F.col("ov")), 6).alias("worth"))


@query(f"""WITH {OVERLAPS}, r AS (SELECT *, ov / a1 AS f, ov / a2 AS b FROM o)
  SELECT l1, l2, round(CASE WHEN greatest(f, b) < 0.2 OR least(f, b) < 0.14 THEN -0.2 ELSE greatest(f, b) * pow(least(a1, a2), 0.8) END, 6) AS cost FROM r""")
def p17_clique_link_cost(spark, d):
    cost = S.clique_link_cost(F.col("a1"), F.col("a2"), F.col("ov") / F.col("a1"), F.col("ov") / F.col("a2"), 0.8, 0.2, 0.14)
    return overlaps(spark, d).select("l1", "l2", F.round(cost, 6).alias("cost"))


STUMPS = [("v", 0.0, -0.5, 0.7), ("v", 0.2, 0.1, -0.3), ("x", 31.0, 0.25, -0.125)]


def _stump_score():
    return sum((F.when(F.col(name) <= thr, low).otherwise(high) for name, thr, low, high in STUMPS), F.lit(0.0))


@query(f"WITH {IMG} SELECT y, x, round(CASE WHEN v <= 0 THEN -0.5 ELSE 0.7 END + CASE WHEN v <= 0.2 THEN 0.1 ELSE -0.3 END + CASE WHEN x <= 31 THEN 0.25 ELSE -0.125 END, 6)::DOUBLE AS score FROM img")
def p18_stump_sum(spark, d):
    return img(spark, d).select("y", "x", F.round(_stump_score(), 6).alias("score"))


@query(f"WITH {IMG} SELECT y, x, round(1 / (1 + exp(-v)), 9) AS p FROM img")
def p19_logistic(spark, d):
    return img(spark, d).select("y", "x", F.round(S.logistic(F.col("v")), 9).alias("p"))


@query(f"WITH {IMG}, m AS (SELECT *, min(v) OVER (PARTITION BY y) AS lo, max(v) OVER (PARTITION BY y) AS hi FROM img) SELECT y, x, round(CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0 END, 9) AS v FROM m")
def p20_min_max(spark, d):
    w = W.partitionBy("y")
    lo, hi = F.min("v").over(w), F.max("v").over(w)
    return img(spark, d).select("y", "x", F.round(F.when(hi > lo, (F.col("v") - lo) / (hi - lo)).otherwise(0.0), 9).alias("v"))


@query(f"""WITH {IMG}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY v, y, x) - 1 AS k, count(*) OVER (PARTITION BY label) AS n FROM img),
  s AS (SELECT label, max(CASE WHEN k = floor(n * 0.0025) THEN v END) AS lo, max(CASE WHEN k = floor(n * 0.9975) THEN v END) AS hi FROM r GROUP BY label)
  SELECT y, x, round(least(greatest((v - lo) * (255 / (hi - lo)), 0), 255) / 255, 7) AS v FROM img JOIN s USING (label)""")
def p21_saturated_stretch(spark, d):
    """The two order statistics come from one sort of each stack's values; the rest is a broadcast join."""
    i = img(spark, d)
    w = W.partitionBy("label")
    ranked = i.withColumn("k", F.row_number().over(w.orderBy("v", "y", "x")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    at = lambda q: F.max(F.when(F.col("k") == F.floor(F.col("n") * q), F.col("v")))
    limits = ranked.groupBy("label").agg(at(0.0025).alias("lo"), at(0.9975).alias("hi"))
    v = F.least(F.greatest((F.col("v") - F.col("lo")) * (255 / (F.col("hi") - F.col("lo"))), F.lit(0.0)), F.lit(255.0)) / 255
    return i.join(limits, "label").select("y", "x", F.round(v, 7).alias("v"))


@query(f"WITH {VOX} SELECT z, y, x FROM vox WHERE p > 50")
def p22_threshold_mask(spark, d):
    return vox(spark, d).where("p > 50").select("z", "y", "x")


@query(f"WITH {VOX} SELECT event_id, floor((1 - p / 1000) * 2147483648)::BIGINT AS v FROM vox")
def p23_inverted_integer(spark, d):
    return vox(spark, d).select("event_id", S.inverted_integer(F.col("p") / 1000).alias("v"))


@query(f"WITH {VOX}, q AS (SELECT event_id, p / 1000 AS p FROM vox) SELECT event_id, round(CASE WHEN p >= 0.3 THEN 2 * (p - 0.3) ELSE 0 END, 9) AS up, round(CASE WHEN p >= 0.3 THEN 0 ELSE -2 * (p - 0.3) END, 9) AS down FROM q")
def p24_terminal_weights(spark, d):
    up, down = S.terminal_weights(F.col("p") / 1000, 0.3)
    return vox(spark, d).select("event_id", F.round(up, 9).alias("up"), F.round(down, 9).alias("down"))


@query(f"WITH {IMG} SELECT a.y, a.x, round(exp(-0.5 * (a.v - b.v) * (a.v - b.v) / 0.01) / (0.1 * sqrt(2 * pi())), 6) AS w FROM img a JOIN img b ON a.y = b.y AND b.x = a.x + 1")
def p25_gaussian_affinity(spark, d):
    w = W.partitionBy("y").orderBy("x")
    ahead = img(spark, d).withColumn("n", F.lead("v").over(w)).where("n is not null")
    return ahead.select("y", "x", F.round(S.gaussian_affinity(F.col("v") - F.col("n"), 0.1), 6).alias("w"))


@query(f"WITH {IMG} SELECT y, x, dx::INT AS dx, dy::INT AS dy, round(abs(v) * exp(-0.5 * (v - 0.5) * (v - 0.5) / (0.2 * 0.2)) / sqrt(dx * dx + dy * dy), 6) AS w FROM img, (VALUES (1, 0), (1, 1), (0, 1), (-1, 1)) t(dx, dy)")
def p26_directional_affinity(spark, d):
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((1, 0), (1, 1), (0, 1), (-1, 1))]))
    i = img(spark, d).withColumn("s", steps).select("y", "x", "v", "s.dx", "s.dy")
    return i.select("y", "x", "dx", "dy", F.round(S.directional_affinity(F.col("v"), F.col("v"), 0.5, 0.2, F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))), 6).alias("w"))


@query("""WITH e AS (SELECT vec_id AS y, [x::DOUBLE for x in embedding] AS e FROM embeddings)
  SELECT y, round(greatest(0, e[1], e[2], e[8]), 7)::DOUBLE AS o0, round(greatest(0, e[2], e[3], e[4]), 7)::DOUBLE AS o45, round(greatest(0, e[4], e[5], e[6]), 7)::DOUBLE AS o90, round(greatest(0, e[6], e[7], e[8]), 7)::DOUBLE AS o135 FROM e""")
def p27_orientation_rounding(spark, d):
    e = table(spark, d, "embeddings")
    axes = S.rounded_orientations([F.col("embedding")[i].cast("double") for i in range(8)])
    return e.select(F.col("vec_id").alias("y"), *[F.round(a, 7).alias(f"o{n}") for a, n in zip(axes, (0, 45, 90, 135))])


@query(f"""WITH {VOX}, palette AS (SELECT i, (i * 7919 % 256)::INT AS r, (i * 104729 % 256)::INT AS g, (i * 1299709 % 256)::INT AS b FROM range(10000) t(i))
  SELECT z, y, x, CASE WHEN label_a = 1 THEN 128 ELSE (r + 128) // 2 END::INT AS r, CASE WHEN label_a = 1 THEN 128 ELSE (g + 128) // 2 END::INT AS g, CASE WHEN label_a = 1 THEN 128 ELSE (b + 128) // 2 END::INT AS b
  FROM vox JOIN palette ON label_a % 10000 = i""")
def p28_colour_overlay(spark, d):
    """A palette row by id modulo its length, blended half with gray 128; label 1 (boundary) is gray. The palette is an expression: no join."""
    i = F.col("label_a") % 10000
    blend = lambda prime: F.when(F.col("label_a") == 1, 128).otherwise(F.floor((i * prime % 256 + 128) / 2)).cast("int")
    return vox(spark, d).select("z", "y", "x", blend(7919).alias("r"), blend(104729).alias("g"), blend(1299709).alias("b"))


@query("""SELECT p_partkey, list_reduce(list_prepend(0::BIGINT, [ord(c)::BIGINT for c in string_split(p_name, '')]), lambda h, c: (c + h * 65599) % 4294967296)::BIGINT AS h FROM part""")
def p29_sdbm_hash(spark, d):
    return table(spark, d, "part").select("p_partkey", S.sdbm(F.col("p_name")).alias("h"))


@query("SELECT vec_id, CASE WHEN embedding[1]::DOUBLE >= embedding[2]::DOUBLE THEN 1 ELSE 2 END AS cls FROM embeddings")
def p30_class_argmax(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.when(e[0] >= e[1], 1).otherwise(2).alias("cls"))


@query(f"WITH {VOX} SELECT z, (19 - x)::INT AS y, y AS x, label_a FROM vox")
def p31_rot90(spark, d):
    return V.rotated(vox(spark, d).select("z", "y", "x", "label_a"), 20, 20)


@query("SELECT p_partkey, try_cast(regexp_replace(p_brand || '_' || p_partkey, '[^0-9]', '', 'g') AS BIGINT) AS k FROM part")
def p32_digits_key(spark, d):
    return table(spark, d, "part").select("p_partkey", S.digits_key(F.concat("p_brand", F.lit("_"), F.col("p_partkey").cast("string"))).alias("k"))


@query(f"WITH {VOX}, p AS (SELECT DISTINCT z FROM vox) SELECT z, row_number() OVER (ORDER BY abs(z - 7), z)::INT AS visit FROM p")
def p33_outward_order(spark, d):
    return vox(spark, d).select("z").distinct().select("z", F.row_number().over(W.orderBy(F.abs(F.col("z") - 7), "z")).alias("visit"))


@query("""WITH s AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS s FROM orders)
  SELECT o_orderkey, CASE WHEN s // 3600 > 0 THEN (s // 3600) || 'h ' || (s // 60 % 60) || 'm ' || (s % 60) || 's' WHEN s // 60 % 60 > 0 THEN (s // 60 % 60) || 'm ' || (s % 60) || 's' ELSE (s % 60) || 's' END AS t FROM s""")
def p34_hms(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.hms(F.floor("o_totalprice").cast("long")).alias("t"))


@query("""WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c FROM embeddings), n AS (SELECT *, sqrt(a * a + b * b + c * c) AS l, min(a) OVER () AS lo, max(a) OVER () AS hi FROM e)
  SELECT vec_id, round(2 * (a - lo) / (hi - lo) - 1, 7) AS sx, round(a / l, 7) AS nx, round(b / l, 7) AS ny, round(c / l, 7) AS nz FROM n""")
def p35_rescale_unit(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate("abc")])
    box = e.agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    length = F.sqrt(F.col("a") * F.col("a") + F.col("b") * F.col("b") + F.col("c") * F.col("c"))
    return e.crossJoin(F.broadcast(box)).select("vec_id", F.round(2 * (F.col("a") - F.col("lo")) / (F.col("hi") - F.col("lo")) - 1, 7).alias("sx"), *[F.round(F.col(c) / length, 7).alias(n) for c, n in zip("abc", ("nx", "ny", "nz"))])


@query("""WITH t AS (SELECT o_orderkey, o_custkey || ':' || (o_orderkey % 7) || ',' || (o_orderkey % 11) AS s FROM orders)
  SELECT o_orderkey, string_split(s, ':')[1]::BIGINT AS main, (string_split(string_split(s, ':')[2], ',')[1]::BIGINT + string_split(string_split(s, ':')[2], ',')[2]::BIGINT) AS rest FROM t""")
def p36_id_list(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit(":"), (F.col("o_orderkey") % 7).cast("string"), F.lit(","), (F.col("o_orderkey") % 11).cast("string")).alias("s"))
    main, rest = S.id_list(F.col("s"))
    return o.select("o_orderkey", main.alias("main"), F.aggregate(rest, F.lit(0).cast("long"), lambda a, b: a + b).alias("rest"))


@query(f"WITH {VOX} SELECT z, y, x, (label_a * 13 % 251)::BIGINT AS colour FROM vox")
def p38_debug_colour(spark, d):
    return vox(spark, d).select("z", "y", "x", (F.col("label_a") * 13 % 251).alias("colour"))
