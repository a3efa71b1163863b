"""Sinks: tables committed as a whole and checked on reading back, planes, overlays and text exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..schema import assert_schema


def commit(df: DataFrame, path: str, name: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Writes df beside path, reads it back and checks its schema, and only then puts it in the place of what was there.

    A failure before the switch leaves the old table untouched.
    """
    spark = df.sparkSession
    partial = f"{path.rstrip('/')}_partial-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(partial)
    back = spark.read.schema(df.schema).parquet(partial)
    if name:
        assert_schema(back, name)
    back.limit(1).collect()
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(partial), hadoop.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {partial} to {path}")
    return spark.read.schema(df.schema).parquet(path)


def fused(df: DataFrame, segment: str, label: str) -> DataFrame:
    """(z, y, x, seglabel, label): the segment's and the object's label of a voxel, in one table."""
    return df.select("z", "y", "x", F.col(segment).alias("seglabel"), F.col(label).alias("label"))


def matched_pair(first: DataFrame, second: DataFrame, merges: DataFrame, folder: str, number: int) -> None:
    """Writes the two blocks of a pair, (z, y, x, label), and its part of the merge table, all under the pair's number.

    A pair that is written again replaces itself, so the merge table never holds its merges twice.
    """
    for side, block in (("first", first), ("second", second)):
        commit(block.select("z", "y", "x", "label"), f"{folder}/blocks/pair={number}/side={side}")
    commit(merges.select("a", "b"), f"{folder}/merges/pair={number}")


def merge_table(spark: SparkSession, folder: str) -> DataFrame:
    """(a, b): the merges of all pairs."""
    return spark.read.parquet(f"{folder}/merges").select("a", "b")


def compressed(df: DataFrame, label: str) -> DataFrame:
    """(z, y, x, n, label): runs of equal labels along x."""
    line = W.partitionBy("z", "y").orderBy("x")
    begins = (F.coalesce(F.lag(label).over(line) != F.col(label), F.lit(True)) | (F.lag("x").over(line) + 1 != F.col("x"))).cast("int")
    run = df.select("z", "y", "x", F.col(label).alias("label"), begins.alias("b"))
    run = run.withColumn("k", F.sum("b").over(line.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy("z", "y", "k", "label").agg(F.min("x").alias("x"), F.count(F.lit(1)).cast("int").alias("n")).select("z", "y", "x", "n", "label")


def label_plane(df: DataFrame, z: int, label: str = "label") -> DataFrame:
    """(y, x, label): a plane of the stack; the predicate reaches the scan."""
    return df.where(F.col("z") == z).select("y", "x", F.col(label).alias("label"))


def forest_text(forest: DataFrame, path: str) -> None:
    """A forest or stumps as a table of nodes, a line of JSON each (see sources.readers.forest)."""
    forest.write.mode("overwrite").json(path)


def probabilities(df: DataFrame, p: str) -> DataFrame:
    """The probability with the columns that later stages need: the original image and the membrane features."""
    kept = [c for c in df.columns if c == "original" or c.startswith("membrane_")]
    return df.select("z", "y", "x", F.col(p).alias("p"), *kept)


def overlay(df: DataFrame) -> DataFrame:
    """(z, y, x, rgb text) of colour columns."""
    return df.select("z", "y", "x", F.format_string("#%02x%02x%02x", "r", "g", "b").alias("rgb"))


def solver_text(objective: DataFrame, rows: DataFrame, path: str) -> None:
    """An LP file from objective(name, cost) and rows(row, name, coef, sense, rhs)."""
    def signed(c):
        value = F.col(c).cast("double")
        return F.concat(F.when(value >= 0, "+").otherwise(""), value.cast("string"))

    def term(c):
        return F.concat(signed(c), F.lit(" "), "name")

    goal = objective.agg(F.array_join(F.sort_array(F.collect_list(term("cost"))), " ").alias("t")).select(F.lit(0).alias("k"), F.lit("").alias("row"), F.concat(F.lit("Maximize\n obj: "), "t", F.lit("\nSubject To")).alias("value"))
    body = rows.groupBy("row", "sense", "rhs").agg(F.array_join(F.sort_array(F.collect_list(term("coef"))), " ").alias("t")).select(F.lit(1).alias("k"), "row", F.concat(F.lit(" "), "row", F.lit(": "), "t", F.lit(" "), "sense", F.lit(" "), F.col("rhs").cast("double").cast("string")).alias("value"))
    names = objective.select(F.lit(2).alias("k"), F.col("name").alias("row"), F.concat(F.lit(" "), "name").alias("value"))
    head = objective.sparkSession.createDataFrame([(2, "", "Binary"), (3, "", "End")], "k int, row string, value string")
    goal.unionByName(body).unionByName(names).unionByName(head).repartitionByRange(1, "k", "row").sortWithinPartitions("k", "row").select("value").write.mode("overwrite").text(path)


def mesh_text(vertices: DataFrame, path: str) -> None:
    """Lines `label x y z nx ny nz`: places scaled to [-1, 1] over each axis, unit normals."""
    box = vertices.agg(*[f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))])
    length = F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz"))
    scaled = [F.when(F.col(f"{c}1") > F.col(f"{c}0"), 2 * (F.col(c) - F.col(f"{c}0")) / (F.col(f"{c}1") - F.col(f"{c}0")) - 1).otherwise(0.0) for c in "xyz"]
    numbers = [F.format_string("%.6f", v) for v in (*scaled, *[F.try_divide(F.col(f"n{c}"), length) for c in "xyz"])]
    vertices.crossJoin(F.broadcast(box)).select(F.concat_ws(" ", F.col("label").cast("string"), *numbers).alias("value")).write.mode("overwrite").text(path)
