"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their id; a document's virtual finish time is the words its
source has sent up to and including it, divided by the source's target. All documents (with repeats, where a
target exceeds its source) are range-sorted by that time, and the queue is cut where the total budget is
spent. Both running sums are sums over ranges, so a source that holds a third of the rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, parallelism, running_sum, small_side, stored

#: Weights by rank of the source (fixed by the contract), and the most often that a document is taken.
WEIGHTS = (5, 2, 1)
REPEATS = 3


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> (source, source_size, target, total): shares of the total by weight, none above
    REPEATS times its source, the excess shared again by weight.

    In the order of cap / weight, a source is capped if the level at which the rest would fill exceeds its cap.
    The windows run over one row per source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.withColumn("w", weights).withColumn("cap", F.lit(REPEATS) * F.col("source_size"))
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(W.partitionBy(F.lit(0)))
    above = F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1))
    rest = F.sum("w").over(by.rowsBetween(0, W.unboundedFollowing))
    level = (total - F.coalesce(above, F.lit(0))) / rest
    levelled = ranked.withColumn("total", total).withColumn("level", level).withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    fill = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), "source", "level"))).over(W.partitionBy(F.lit(0)))["level"]
    return levelled.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * fill)).select("source", "source_size", "target", "total")


#: Entries of a range that are summed row by row in one task.
ROWS = 1 << 20


def _cut(sent: DataFrame, keys: list[str], total: int):
    """The key of the first entry, in the order of keys, with which the running sum of size exceeds total; None if none does.

    The entries are range-sorted; a sum per range reaches the driver, and the range in which the budget ends is sorted
    into ranges again until it has at most ROWS entries (or holds equal keys only); only these are summed row by row.
    """
    n = parallelism(sent.sparkSession)
    part, before, size = sent.select(*keys, "size"), 0, None
    while True:
        ranged = stored(part.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "queue")
        found = None
        for r in sorted(ranged.groupBy("_range").agg(F.sum("size").alias("own"), F.count(F.lit(1)).alias("n")).collect()):
            if before + (r["own"] or 0) > total:
                found = r
                break
            before += r["own"] or 0
        if found is None:
            return None
        part = ranged.where(F.col("_range") == found["_range"]).select(*keys, "size")
        if found["n"] <= ROWS or found["n"] == size:
            break
        size = found["n"]
    own = part.withColumn("spent", F.sum("size").over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)))
    return own.where(F.col("spent") > total - before).agg(F.min(F.struct(*keys))).first()[0]


def mixed(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each row of docs, and, where `row` names the rows, row.

    size: words of the text (null: 0). taken: words that the mix takes of the row, up to REPEATS times its size.
    The document at which the budget (the sum of all sizes) would be exceeded, and all after it, are left out.
    Rows without words take 0. A null source is a source of its own, last in order. Repeated rows are queued one
    after the other. An empty table gives no rows; extra columns are ignored.
    """
    words = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(words).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"), *([] if row is None else [row.alias("row")]))
    sized = stored(sized, "sized")
    extra = [] if row is None else ["row"]
    aims = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "s"), "targets")
    queued = running_sum(sized, ["h", "doc_id", "size", *extra], "size", "sent", group="source")
    queued = stored(queued.join(small_side(aims), queued["source"].eqNullSafe(aims["s"])).drop("s"), "queued")
    total = aims.agg(F.max("total")).first()[0] or 0

    def finish(round_):
        return F.when(F.col("target") > 0, (round_ * F.col("source_size") + F.col("sent")) / F.col("target")).otherwise(F.lit(0.0))

    last = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))) + 1, F.lit(REPEATS - 1)).cast("int")
    sent = queued.where("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), last)))
    cut = _cut(sent.withColumn("finish", finish(F.col("round"))), ["finish", "h", "doc_id", "round"], total)
    times = F.lit(0)
    for k in range(REPEATS):
        goes = F.lit(k) <= last
        if cut is not None:
            at = (cut["finish"], cut["h"], cut["doc_id"], cut["round"])
            same_id = F.col("doc_id").isNull() if at[2] is None else F.col("doc_id").eqNullSafe(F.lit(at[2]))
            under_id = F.lit(False) if at[2] is None else F.coalesce(F.col("doc_id") < at[2], F.lit(True))
            f = finish(F.lit(k))
            goes = goes & ((f < at[0]) | ((f == at[0]) & ((F.col("h") < at[1]) | ((F.col("h") == at[1]) & (under_id | (same_id & (F.lit(k) < at[3])))))))
        times = times + goes.cast("int")
    return queued.select("doc_id", "source", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"), *extra)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs with each row as often as the mix takes it; rows without words are left out.

    Rows are told apart by a hash of their columns, so rows of one doc_id (or of a null one) are each taken as `mixed`
    says. Wholly equal rows are interchangeable: together they stand as often as they are taken together.
    """
    plain = [c for c in docs.columns if "map" not in docs.schema[c].dataType.simpleString()]
    row = F.struct(F.xxhash64(*plain).alias("a"), F.xxhash64(F.lit(1), *plain).alias("b"))
    chosen = mixed(docs, row).where("taken > 0").groupBy("row").agg(F.sum((F.col("taken") / F.col("size")).cast("long")).alias("_lamella_times"))
    chosen = chosen.select(F.col("row").alias("_lamella_key"), "_lamella_times")
    own = docs.withColumn("_lamella_row", row)
    # Of equal rows the first takes the copies; they are numbered where their hash is shared.
    joined = own.join(chosen.hint("merge"), own["_lamella_row"] == chosen["_lamella_key"])
    number = F.row_number().over(W.partitionBy("_lamella_key").orderBy("_lamella_times"))
    first = joined.withColumn("_lamella_number", number).where("_lamella_number = 1")
    return first.withColumn("_lamella_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_lamella_times")))).select(*docs.columns)


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
copies AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source, size) AS copy FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM copies GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         3 * source_size AS cap FROM sources),
levels AS (
  SELECT *, (SELECT sum(source_size)::BIGINT FROM sources) AS total,
         ((SELECT sum(source_size)::BIGINT FROM sources) - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
fill AS (SELECT level AS filled FROM levels WHERE cap / w > level ORDER BY cap / w, source NULLS LAST LIMIT 1),
aims AS (
  SELECT source, source_size, total,
         CASE WHEN cap / w <= level THEN cap::DOUBLE ELSE w * (SELECT filled FROM fill) END AS target FROM levels),
sent AS (
  SELECT c.*, a.source_size, a.target, a.total,
         sum(c.size) OVER (PARTITION BY c.source ORDER BY c.h, c.doc_id, c.copy ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
  FROM copies c JOIN aims a ON c.source IS NOT DISTINCT FROM a.source),
entries AS (
  SELECT s.*, r.round, CASE WHEN target > 0 THEN (r.round * source_size + s.sent)::DOUBLE / target ELSE 0 END AS finish
  FROM sent s JOIN (VALUES (0), (1), (2)) r(round)
    ON r.round <= CASE WHEN size > 0 THEN least(floor(target / greatest(source_size, 1)) + 1, 2) ELSE 0 END),
spent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id NULLS FIRST, round ROWS UNBOUNDED PRECEDING)::BIGINT AS spent FROM entries),
cut AS (SELECT finish, h, doc_id, round FROM spent WHERE spent > total ORDER BY finish, h, doc_id NULLS FIRST, round LIMIT 1)
SELECT e.doc_id, e.size, e.source_size, e.target,
       sum(CASE WHEN (SELECT count(*) FROM cut) = 0 OR (e.finish, e.h, coalesce(e.doc_id, -9223372036854775808), e.round) < (SELECT (finish, h, coalesce(doc_id, -9223372036854775808), round) FROM cut) THEN e.size ELSE 0 END)::BIGINT AS taken
FROM entries e GROUP BY doc_id, copy, source, size, source_size, target
"""
