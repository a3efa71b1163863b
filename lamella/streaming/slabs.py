"""Incremental slabs: label overlaps of new slabs are matched as they arrive, and merges accumulate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.components import global_map
from ..operators.overlap import matches_theta
from ..schema import schema_of

SLAB = "slab int, z int, y int, x int, label bigint, below bigint"


def slab_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Slabs as they are added to a folder: each voxel of the shared planes with its label and that of the slab below."""
    return spark.readStream.schema(SLAB).parquet(folder)


def merge_slabs(stream: DataFrame, merges: str, checkpoint: str, large: float = 20000, small: float = 2000):
    """Starts a query that appends each batch's merges (a, b) to a table; areas are those of the batch.

    A batch is written under its number, so one that is repeated after a failure replaces itself.
    """

    def batch(df: DataFrame, number: int) -> None:
        both = df.where("label > 0 and below > 0")
        ov = both.groupBy("slab", F.col("below").alias("a"), F.col("label").alias("b")).agg(F.count(F.lit(1)).alias("ov"))
        a1 = df.groupBy("slab", F.col("below").alias("a")).agg(F.count(F.lit(1)).alias("a1"))
        a2 = df.groupBy("slab", F.col("label").alias("b")).agg(F.count(F.lit(1)).alias("a2"))
        found = ov.join(a1, ["slab", "a"]).join(a2, ["slab", "b"]).where(matches_theta(F.col("ov"), F.col("a1"), F.col("a2"), True, large, small))
        found.select("a", "b").write.mode("overwrite").parquet(f"{merges}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_map(spark: SparkSession, merges: str) -> DataFrame:
    """The global map of all merges so far."""
    return global_map(spark.read.schema(schema_of("merges")).parquet(merges))
