"""Session factory and intermediate storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "lamella", **conf: str) -> SparkSession:
    """A session with adaptive execution; conf overrides (dots as double underscores)."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where none is set, a folder under /tmp/checkpoints, but only on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lamella/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written in the shared folder and read back: short lineage that survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
