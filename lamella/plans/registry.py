"""The table of queries, and the views that they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled volume of 20 x 20 planes from events: dense coordinates, probability p, two labellings."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        e, (e % 20).cast("int").alias("x"), (F.floor(e / 20) % 20).cast("int").alias("y"), F.floor(e / 400).cast("int").alias("z"), F.col("value").alias("p"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(1 + F.col("user_id") % 6).cast("long").alias("label_a"),
        (1 + F.floor(F.col("user_id") / 6) % 5).cast("long").alias("label_b"),
    )


VOX = """vox AS (
  SELECT event_id, (event_id % 20)::INT AS x, ((event_id // 20) % 20)::INT AS y, (event_id // 400)::INT AS z, value AS p,
         (CASE WHEN event_type = 'error' THEN 0 ELSE 1 + user_id % 6 END)::BIGINT AS label_a, (1 + (user_id // 6) % 5)::BIGINT AS label_b
  FROM events)"""


def img(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image of 64 columns from embeddings, a row each."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("y"), "label", F.posexplode("embedding").alias("x", "v"))
    return rows.select("y", "x", F.col("v").cast("double").alias("v"), "label")


IMG = """img AS (
  SELECT vec_id::INT AS y, label, (unnest(range(len(embedding))))::INT AS x, unnest(embedding)::DOUBLE AS v FROM embeddings)"""


def pairgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse two-sided graph: suppliers and customers (+ 1000000) that share 4 lines or more; w is their number."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("l_suppkey").alias("src"), (F.col("o_custkey") + 1000000).alias("dst")).agg(F.count(F.lit(1)).cast("double").alias("w")).where("w >= 4")


PAIRS = """pairgraph AS (
  SELECT l_suppkey AS src, o_custkey + 1000000 AS dst, count(*)::DOUBLE AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL HAVING count(*) >= 4)"""


def dense_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of suppliers and nations of customers: (l1, l2, ov)."""
    # Orders meet customers before the lines, so that the lines are shuffled once.
    own = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    lines = table(spark, sf_dir, "lineitem").join(own, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("l_suppkey").alias("l1"), (F.col("c_nationkey").cast("long") + 1).alias("l2")).agg(F.count(F.lit(1)).alias("ov"))


DENSE = """dense AS (
  SELECT l_suppkey AS l1, c_nationkey::BIGINT + 1 AS l2, count(*) AS ov
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
