"""Matching labels of two blocks: thresholds, stable marriage (one or several partners), orphans."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import written
from . import kernels


def matched(pairs: DataFrame, k: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, l1, l2): the stable matching with up to k partners on both sides that l1's propose. pairs(*by, l1, l2, ov).

    Both sides prefer the larger overlap, the smaller id first on ties. In a round every l1 proposes to the first k on
    its list, and every l2 holds the best k of its proposers. Once an l2 holds k, pairs that it likes less than all of
    them can never hold again and leave the table, so a round works on open pairs only. The rounds end when none leaves:
    then every proposal is held. The outcome does not depend on an order of proposals.
    """
    likes = F.row_number().over(W.partitionBy(*by, "l1").orderBy(F.col("ov").desc(), "l2"))
    liked = F.row_number().over(W.partitionBy(*by, "l2").orderBy(F.col("ov").desc(), "l1"))
    live = written(pairs.select(*by, "l1", "l2", likes.alias("r1"), liked.alias("r2")), "open")
    n = live.count()
    while True:
        proposed = live.withColumn("p", F.row_number().over(W.partitionBy(*by, "l1").orderBy("r1"))).where(F.col("p") <= k)
        held = proposed.withColumn("h", F.row_number().over(W.partitionBy(*by, "l2").orderBy("r2"))).where(F.col("h") <= k)
        worst = held.groupBy(*by, "l2").agg(F.max("r2").alias("worst"), F.count(F.lit(1)).alias("size")).where(F.col("size") == k).drop("size")
        live = written(live.join(worst, [*by, "l2"], "left").where("worst is null or r2 <= worst").select(*by, "l1", "l2", "r1", "r2"), "open")
        left = live.count()
        if left == n:
            return proposed.select(*by, "l1", "l2")
        n = left


def stable(pairs: DataFrame) -> DataFrame:
    """(l1, l2): the stable matching of pairs(l1, l2, ov), one partner each."""
    return matched(pairs)


def polygamous(pairs: DataFrame, k: int, by: str = "pair") -> DataFrame:
    """(by, l1, l2): up to k partners each, every block pair for itself."""
    return matched(pairs, k, (by,))


def orphans(pairs: DataFrame, matched: DataFrame, total: float | None = None, least_overlap: float = 0.9, least_total: float = 0.001, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, l1, l2): each label's best partner that covers enough of it and of the slab, both ways, unless matched already.

    pairs(*by, l1, l2, ov, a1, a2); the slab's size is total, or a column of that name.
    """
    size, out = F.col("total") if total is None else F.lit(float(total)), None
    for own, other, area in (("l1", "l2", "a1"), ("l2", "l1", "a2")):
        best = pairs.withColumn("r", F.row_number().over(W.partitionBy(*by, own).orderBy(F.col("ov").desc(), other))).where("r = 1")
        best = best.where((F.col("ov") / F.col(area) >= least_overlap) & (F.col("ov") / size >= least_total)).select(*by, "l1", "l2")
        out = best if out is None else out.unionByName(best)
    return out.join(matched.select(*by, "l1", "l2"), [*by, "l1", "l2"], "left_anti").distinct()


def multimatch(pairs: DataFrame, k: int, least_partner: float = 0.001, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, l1, l2): the live matcher, every block pair (by) for itself: filter by share of the slab, k-partner matching, orphans.

    pairs(*by, l1, l2, ov, a1, a2, total), total being the pair's slab.
    """
    fit = pairs.where(F.col("ov") / F.col("total") >= least_partner)
    engaged = matched(fit, k, by)
    return engaged.unionByName(orphans(fit, engaged, by=by)).distinct()


def nearest(asked: DataFrame, known: DataFrame, ratio: float, asked_rows: int = 4096, known_rows: int = 16384) -> DataFrame:
    """(a, b, dist): of known(b, e) the one nearest to each of asked(a, e), if ratio times its distance is below the second's.

    Distances are sums of squares, rounded to 9 places; equal ones go by b. All pairs are compared: blocks of both sides,
    of a fixed number of rows, meet in one task each, and of a pair of blocks only what can be among the two nearest leaves it.
    """
    asked, known = asked.where("a is not null and e is not null"), known.where("b is not null and e is not null").select("b", F.col("e").alias("e"))
    sides, n = [], [-(-df.count() // most) or 1 for df, most in ((asked, asked_rows), (known, known_rows))]
    for df, own, other in ((asked, 0, 1), (known, 1, 0)):
        dealt = df.withColumn(f"k{own}", F.monotonically_increasing_id() % n[own])
        sides.append(dealt.withColumn(f"k{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n[other] - 1).cast("long")))).groupBy("k0", "k1"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        one, two = left.combine_chunks(), right.combine_chunks()
        i, b, d = kernels.two_nearest(*[kernels.padded(t["e"].chunk(0)) for t in (one, two)], two["b"].to_numpy())
        return pa.table({"a": one["a"].to_numpy()[i], "b": b, "d": d})

    found = sides[0].cogroup(sides[1]).applyInArrow(run, "a long, b long, d double").select("a", F.struct(F.round("d", 9).alias("dist"), "b").alias("m"))
    ranked = found.withColumn("r", F.row_number().over(W.partitionBy("a").orderBy("m"))).where("r <= 2")
    two = ranked.groupBy("a").agg(F.min("m").alias("first"), F.max("m").alias("second"), F.count(F.lit(1)).alias("n")).where("n = 2")
    return two.where(ratio * F.col("first.dist") < F.col("second.dist")).select("a", F.col("first.b").alias("b"), F.col("first.dist").alias("dist"))
