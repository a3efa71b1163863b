"""Shared plumbing: tables, intermediate storage, distributed running sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: ASCII white space that separates words (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session.

    Where none is set a folder under /tmp/checkpoints is, but only on one machine (a local master): elsewhere it would
    deal the intermediate tables over the machines, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lamella/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back: a cut of lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stable_fraction(*parts: Column | str) -> Column:
    """A uniform long from the values of parts, equal on every run."""
    return F.xxhash64(*parts)


def running_sum(df: DataFrame, order: list[str], value: str, out: str, group: str | None = None) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows up to and including this one, in `order` (which must be unique), within `group`.

    The rows are range-sorted once; each range's sum (a row per range and group) is summed over ranges, so no
    group, whatever its size, meets in one task. Rows of a range are then summed within (range, group).
    Nulls in `value` count as 0. The sizes of the broadcast offsets are ranges + groups rows.
    """
    from pyspark.sql import Window as W

    spark = df.sparkSession
    keys = ([group] if group else []) + order
    n = parallelism(spark)
    ranged = stored(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "ranged")
    by = ["_range", group] if group else ["_range"]
    value_or_0 = F.coalesce(F.col(value), F.lit(0))
    sums = ranged.groupBy(*by).agg(F.sum(value_or_0).alias("_own"))
    over = (W.partitionBy(group) if group else W.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = sums.withColumn("_before", F.coalesce(F.sum("_own").over(over), F.lit(0))).drop("_own")
    on = ranged["_range"].eqNullSafe(before["_range"])
    if group:
        on = on & ranged[group].eqNullSafe(before[group])
    joined = ranged.join(before.select(F.col("_range").alias("_r"), *([F.col(group).alias("_g")] if group else []), "_before"),
                         (F.col("_range") == F.col("_r")) & (F.col(group).eqNullSafe(F.col("_g")) if group else F.lit(True)), "left")
    within = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return joined.withColumn(out, F.col("_before") + F.sum(value_or_0).over(within)).drop("_range", "_r", "_g", "_before")


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


#: Rows of a table that may be broadcast (a row is a key and a few numbers: under 32 MB).
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if a count shows that it has at most `limit` rows; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Bits of a membership bitmap: 4 MB, whatever the number of ids.
BITMAP_BITS = 1 << 25


def bitmap(places: DataFrame):
    """A broadcast bitmap of places(p), numbers below BITMAP_BITS; None if so many are set that it would let most rows pass.

    Rows that it lets pass in error are for the caller to remove. At most BITMAP_BITS / 64 rows reach the driver.
    """
    import numpy as np

    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    found = words.toPandas()
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    bits[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    flags = bits.view(np.uint8)
    if np.unpackbits(flags).mean() > 0.25:
        return None
    return places.sparkSession.sparkContext.broadcast(flags)


def restricted(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of docs whose `key` (a long) is in ids(key), and perhaps a few others, texts unshuffled where that can be.

    Up to BROADCAST_ROWS ids are broadcast; more pass through a bitmap of fixed size; too many for that are joined.
    """
    ids = stored(ids.select(F.col(key).alias("_wanted")).where("_wanted is not null").distinct(), "wanted")
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return docs.join(F.broadcast(ids), F.col(key) == F.col("_wanted"), "left_semi")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS))
    flags = bitmap(ids.select(place("_wanted").alias("p")))
    if flags is None:
        return docs.join(ids.hint("merge"), F.col(key) == F.col("_wanted"), "left_semi")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = is_set(flags.value, batch.column(batch.num_columns - 1).to_numpy())
            yield batch.filter(pa.array(keep)).select(range(batch.num_columns - 1))

    return docs.where(F.col(key).isNotNull()).select("*", place(key).alias("_place")).mapInArrow(run, docs.schema)


def is_set(flags, p):
    """Which of the places p (a NumPy array) are set; bits count from the lowest of each byte."""
    return (flags[p >> 3] >> (p & 7)) & 1 == 1
