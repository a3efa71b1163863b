"""Global reconciliation of labels: components of a merge table, dense remapping, lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written
from .overlap import dense_ids


def roots(merges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(id, root): the least id connected with each id of the table; pairs with background or nulls are ignored.

    Min-label propagation with pointer jumping: a round takes the least root among an id's neighbours and then the
    root of that root, so paths shorten geometrically. Rounds are written; the loop ends when no root changes.
    """
    pairs = merges.where((F.col(a) > 0) & (F.col(b) > 0)).select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = written(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    state = written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "id"), "roots")
    for _ in range(max_rounds):
        near = edges.join(state.select(F.col("id").alias("v"), F.col("root").alias("r")), "v").groupBy(F.col("u").alias("id")).agg(F.min("r").alias("near"))
        hooked = state.join(near, "id").select("id", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        jumps = state.select(F.col("id").alias("root"), F.col("root").alias("up"))
        moved = written(hooked.join(jumps, "root").select("id", F.least("root", "up").alias("root"), "old"), "roots")
        changed = moved.where("root <> old").limit(1).count()
        state = moved.select("id", "root")
        if not changed:
            return state
    raise RuntimeError("roots did not settle")


def global_map(merges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(old, new): dense ids from 1 by ascending root, and 0 for 0."""
    found = roots(merges, a, b)
    ranks = dense_ids(found.select("root"), "root")
    background = merges.sparkSession.createDataFrame([(0, 0)], "old long, new long")
    return found.join(ranks, "root").select(F.col("id").alias("old"), "new").unionByName(background)


def with_identities(merges: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """The merge table and a pair (l, l) for every label, so that unmatched labels have a place in the map."""
    own = labels.where(F.col(label) > 0).select(F.col(label).alias("a"), F.col(label).alias("b")).distinct()
    return merges.select("a", "b").unionByName(own)


def remapped(labels: DataFrame, remap: DataFrame, label: str = "label") -> DataFrame:
    """labels with their new ids; a label that the map lacks raises an error when the result is computed.

    The map joins by hash; whether it is broadcast is left to its measured size.
    """
    joined = labels.join(remap.withColumnRenamed("old", "_old"), F.col(label) == F.col("_old"), "left")
    new = F.when(F.col("new").isNull() & F.col(label).isNotNull(), F.raise_error(F.concat(F.lit("label without a place in the map: "), F.col(label).cast("string"))).cast("long")).otherwise(F.col("new"))
    return joined.withColumn(label, new).drop("_old", "new")


def chains(merges: DataFrame) -> DataFrame:
    """(id, root): where the chain of parents of each id ends. merges(hi, lo): an id's parent is the least lo below it.

    One parent an id, unlike `roots`: ids that share a child stay apart. A round replaces each pointer by that of its
    target, so the paths halve; background (0) and pairs with lo >= hi are ignored.
    """
    state = merges.where("lo > 0 and lo < hi").groupBy(F.col("hi").cast("long").alias("id")).agg(F.min("lo").cast("long").alias("root"))
    state = written(state, "chains")
    while True:
        up = state.select(F.col("id").alias("root"), F.col("root").alias("up"))
        moved = written(state.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "chains")
        state = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return state
