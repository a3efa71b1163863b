"""Fusion of candidate segmentations: problem rows, exact solution per conflict component, decoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import kernels
from .components import roots


def problem(segments: DataFrame, sets: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """objective(name, cost) and rows(row, name, coef, sense, rhs) of the fusion program.

    segments(label, worth), sets(set, label), links(l1, l2, worth): at most one segment of a set; a segment is at least
    the sum of its links upwards, and of its links downwards.
    """
    s = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    link = F.concat_ws("_", F.lit("l"), F.col("l1").cast("string"), F.col("l2").cast("string"))
    objective = segments.select(s("label").alias("name"), F.col("worth").alias("cost")).unionByName(links.select(link.alias("name"), F.col("worth").alias("cost")))
    row = lambda name, var, coef, sense, rhs: [name.alias("row"), var.alias("name"), F.lit(coef).alias("coef"), F.lit(sense).alias("sense"), F.lit(rhs).alias("rhs")]
    rows = sets.select(*row(F.concat(F.lit("x"), F.col("set").cast("string")), s("label"), 1.0, "<=", 1.0))
    for side, name in (("l1", "u"), ("l2", "d")):
        rows = rows.unionByName(links.select(*row(F.concat(F.lit(name), F.col(side).cast("string")), link, -1.0, ">=", 0.0)))
        rows = rows.unionByName(links.select(side).distinct().select(*row(F.concat(F.lit(name), F.col(side).cast("string")), s(side), 1.0, ">=", 0.0)))
    return objective, rows


def links_only(segments: DataFrame, sets: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables of a program whose objective is the links' worth alone: segments are worth nothing by themselves."""
    return segments.withColumn("worth", F.lit(0.0)), sets, links


def pairwise(sets: DataFrame) -> DataFrame:
    """(set, a, b): exclusions of two segments each in place of sets(set, label); a set's size is the number of candidates at a pixel."""
    return sets.select("set", F.col("label").alias("a")).join(sets.select("set", F.col("label").alias("b")), "set").where("a < b").distinct()


def branching_rows(links: DataFrame, most: int) -> DataFrame:
    """(row, name, coef, sense, rhs): links of a segment on one side are at most min(their number, most) times it."""
    out = None
    for side, name in (("l1", "u"), ("l2", "d")):
        link = F.concat_ws("_", F.lit("l"), F.col("l1").cast("string"), F.col("l2").cast("string"))
        row = F.concat(F.lit(name), F.col(side).cast("string")).alias("row")
        own = links.groupBy(side).agg(F.count(F.lit(1)).alias("n")).select(row, F.concat(F.lit("s"), F.col(side).cast("string")).alias("name"), (-F.least("n", F.lit(most)).cast("double")).alias("coef"))
        part = links.select(row, link.alias("name"), F.lit(1.0).alias("coef")).unionByName(own).withColumn("sense", F.lit("<=")).withColumn("rhs", F.lit(0.0))
        out = part if out is None else out.unionByName(part)
    return out


def label_loss_rows(segments: DataFrame, links: DataFrame, loss: float) -> DataFrame:
    """(row, name, coef, sense, rhs): area - loss <= sum of the areas of linked segments of the next plane, if the segment is chosen."""
    area = segments.select(F.col("label").alias("l2"), F.col("area").cast("double").alias("a2"))
    row = lambda c: F.concat(F.lit("z"), F.col(c).cast("string")).alias("row")
    name = F.concat_ws("_", F.lit("l"), F.col("l1").cast("string"), F.col("l2").cast("string")).alias("name")
    linked = links.join(area, "l2").select(row("l1"), name, F.col("a2").alias("coef"))
    own = segments.join(links.select(F.col("l1").alias("label")).distinct(), "label").select(row("label"), F.concat(F.lit("s"), F.col("label").cast("string")).alias("name"), (-(F.col("area") - loss)).cast("double").alias("coef"))
    return linked.unionByName(own).withColumn("sense", F.lit(">=")).withColumn("rhs", F.lit(0.0))


def solved(segments: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """(label, chosen): the best selection, exactly, for each component of segments that share a set or a link.

    A component is one task. Links should stay inside a block (as the plans see to), else an object that runs through
    the stack is one component. Segments without conflict cost nothing; the search is exponential in the number of
    conflicting ones of a component at worst.
    """
    pairs = sets.groupBy("set").agg(F.min("label").alias("first")).join(sets, "set").select(F.col("label").alias("a"), F.col("first").alias("b"))
    every = segments.select(F.col("label").alias("a"), F.col("label").alias("b"))
    root = roots(pairs.unionByName(links.select(F.col("l1").alias("a"), F.col("l2").alias("b"))).unionByName(every)).withColumnRenamed("id", "label")
    seg = segments.join(root, "label").select("root", F.lit("s").alias("kind"), F.col("label").alias("a"), F.lit(0).cast("long").alias("b"), F.col("worth").cast("double").alias("w"))
    ex = sets.join(root, "label").select("root", F.lit("x"), "set", "label", F.lit(0.0))
    ln = links.join(root, links["l1"] == root["label"]).select("root", F.lit("l"), "l1", "l2", F.col("worth").cast("double"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf[pdf["kind"] == "s"].sort_values("a")
        place = {v: i for i, v in enumerate(s["a"].tolist())}
        groups: dict[int, set[int]] = {}
        for k, label in zip(pdf.loc[pdf["kind"] == "x", "a"], pdf.loc[pdf["kind"] == "x", "b"]):
            groups.setdefault(k, set()).add(place[label])
        own = pdf[pdf["kind"] == "l"]
        _, chosen = kernels.best_selection(s["w"].tolist(), list(groups.values()), [(place[a], place[b], w) for a, b, w in zip(own["a"], own["b"], own["w"])])
        return pd.DataFrame({"label": s["a"], "chosen": [i in set(chosen) for i in range(len(s))]})

    return seg.union(ex).union(ln).groupBy("root").applyInPandas(run, "label long, chosen boolean")


def fused(candidates: DataFrame, solution: DataFrame, links: DataFrame) -> DataFrame:
    """(z, y, x, label): chosen candidates, linked segments under one label (their least)."""
    chosen = solution.where("chosen").select("label")
    both = links.join(chosen.select(F.col("label").alias("l1")), "l1", "left_semi").join(chosen.select(F.col("label").alias("l2")), "l2", "left_semi")
    root = roots(both.select(F.col("l1").alias("a"), F.col("l2").alias("b")).unionByName(chosen.select(F.col("label").alias("a"), F.col("label").alias("b"))))
    shown = candidates.join(root, candidates["label"] == root["id"])
    return shown.groupBy("z", "y", "x").agg(F.min("root").alias("label"))


def diversified(segments: DataFrame, sets: DataFrame, links: DataFrame, rounds: int = 2) -> DataFrame:
    """(round, label): solutions one after the other; segments chosen before lose half their worth, so that others get a turn."""
    from ..session import written

    out = None
    for k in range(rounds):
        chosen = written(solved(segments, sets, links).where("chosen").select(F.lit(k).alias("round"), "label"), "solution")
        out = chosen if out is None else out.unionByName(chosen)
        segments = written(segments.join(chosen.select("label", F.lit(0.5).alias("_f")), "label", "left").withColumn("worth", F.col("worth") * F.coalesce("_f", F.lit(1.0))).drop("_f"), "segments")
    return out
