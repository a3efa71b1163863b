"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of every whole text are computed once. Means and deviations, the normal equations and the
calibration counts are sums over partitions of all labelled training rows; what reaches the driver are
those sums, of a size fixed by FEATURES and BINS. The ridge is fitted on three of the four training parts
and calibrated on the fourth, which it has not seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import kernels as K
from .common import stored

FEATURES = 384
BINS = 1000
#: Partial sums (1.2 MB each) that are added at a time, and that reach the driver at most.
GATHER = 16
RIDGE = 1e-3
THRESHOLD = 0.3

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.zeros(256, bool)
_HIGH[0xC0:] = True
_STOP, _COMMA, _BANG, _BAR = (K._flags(c) for c in (".", ",;:", "!?", "|"))
N_STATS = 18


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """N_STATS numbers of each row, all finite, also for empty rows."""
    c = K.base_counts(data, offsets)
    starts, ends, first, h = K.words(data, offsets, lower=True)
    words = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    row = np.repeat(np.arange(len(words)), np.diff(first))
    size = ends - starts
    _, at = np.unique(K.mix(h ^ K.mix(row.astype(np.uint64) + K.U(1))), return_index=True)
    distinct = np.bincount(row[at], minlength=len(words))
    longest = np.zeros(len(words))
    np.maximum.at(longest, row, size)
    square = np.bincount(row, weights=size.astype(float) ** 2, minlength=len(words)) / words
    mean = np.bincount(row, weights=size, minlength=len(words)) / words
    of = lambda flags: K.per_row(flags[data], offsets)
    return np.column_stack([
        np.log1p(c["n_words"]), np.log1p(c["n_lines"]), c["word_chars"] / words, np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(longest),
        c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, distinct / words,
        of(_UPPER) / chars, of(_LOWER) / chars, of(_DIGIT) / chars, of(_HIGH) / chars, of(_STOP) / words, of(_COMMA) / words, of(_BANG) / words, of(_BAR) / words,
        np.bincount(row, weights=size <= 3, minlength=len(words)) / words,
    ])


def _statistics(batches):
    for batch in batches:
        for row, data, offsets in K.pieces(batch.column(1)):
            x = statistics(data, offsets).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(x)), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_STATS).astype(float)


def _moments(batches):
    total = np.zeros((3, N_STATS))
    for batch in batches:
        x = _matrix(batch.column(0))
        total += [np.full(N_STATS, len(x)), x.sum(axis=0), (x**2).sum(axis=0)]
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])


class Map:
    """Standardised statistics to random Fourier features (and a constant)."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, deviation
        self.w = rng.normal(size=(N_STATS, FEATURES)) / np.sqrt(N_STATS)
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        return np.column_stack([np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), np.ones(len(x))])


def _equations(to_features: Map):
    """Sums z z' and z y over a partition, as one row of bytes."""

    def run(batches):
        n = FEATURES + 1
        a, b = np.zeros((n, n)), np.zeros(n)
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                z, y = to_features(_matrix(part.column(0))), part.column(1).to_numpy(zero_copy_only=False)
                a += z.T @ z
                b += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([np.vstack([a, b]).tobytes()], pa.binary())], names=["part"])

    return run


def _added(pdf):
    """The sum of a group's byte rows, as one row."""
    import pandas as pd

    return pd.DataFrame({"part": [np.sum([np.frombuffer(x) for x in pdf["part"]], axis=0).tobytes()]})


def _sum_of(parts: DataFrame) -> np.ndarray | None:
    """The sum of the byte rows of all partitions, GATHER of them at a time, in as many rounds as that takes."""
    parts = stored(parts, "parts")
    while (n := parts.count()) > GATHER:
        dealt = parts.withColumn("grp", F.pmod(F.xxhash64(F.substring("part", 1, 512), F.monotonically_increasing_id()), F.lit(-(-2 * n // GATHER))))
        parts = stored(dealt.groupBy("grp").applyInPandas(_added, "part binary"), "parts")
    rows = parts.collect()
    return np.sum([np.frombuffer(r[0]) for r in rows], axis=0) if rows else None


def isotonic(x: np.ndarray, weight: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit by pooling adjacent violators: (x, fitted), x ascending."""
    blocks: list[list[float]] = []
    for w, v in zip(weight, y):
        blocks.append([w, w * v, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return x, np.repeat([s / w for w, s, _ in blocks], [int(n) for *_, n in blocks])


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, calibration: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs(doc_id, text).

    labels(doc_id, quality) teach where held_out (a condition on doc_id) is false; where `calibration` holds too, they
    calibrate. score is the calibrated probability of quality 1; predicted is 1 if it is THRESHOLD or more. Null and
    empty texts have statistics like any other and get a score. Null labels teach nothing, several labels of a document
    each count. With no training rows of both qualities every score is the training share of quality 1, or 0.5 without
    any. Repeated rows are scored alike; a null doc_id is not held out and teaches nothing.
    """
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    known = stored(texts.mapInArrow(_statistics, "doc_id long, x binary"), "statistics")
    marks = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y is not null and doc_id is not null")
    train = stored(known.join(marks, "doc_id").where(~held_out).select("x", "y", calibration.alias("later")), "train")
    share = train.agg(F.count("y"), F.avg("y")).first()
    out = known.select("doc_id", "x", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    if not share[0] or share[1] in (0.0, 1.0):
        constant = F.lit(0.5 if share[1] is None else float(share[1]))
        return out.select("doc_id", "held_out", constant.alias("score"), (constant >= THRESHOLD).cast("int").alias("predicted"))
    n, first, second = _sum_of(train.select("x").mapInArrow(_moments, "part binary")).reshape(3, N_STATS)
    mean = first / n
    to_features = Map(mean, np.sqrt(np.maximum(second / n - mean**2, 0)) + 1e-6)
    sums = _sum_of(train.where("not later").select("x", "y").mapInArrow(_equations(to_features), "part binary"))
    sums = sums.reshape(FEATURES + 2, FEATURES + 1)
    a, b = sums[:-1], sums[-1]
    beta = np.linalg.solve(a + RIDGE * max(a[-1, -1], 1.0) / FEATURES * np.eye(FEATURES + 1), b)

    def raw(x: pa.Array) -> np.ndarray:
        return np.concatenate([to_features(_matrix(x.slice(low, 4096))) @ beta for low in range(0, len(x), 4096)] or [np.zeros(0)])

    def bin_of(scores: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((scores + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)

    def binned(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bin_of(raw(batch.column(0)))), batch.column(1)], names=["bin", "y"])

    counts = train.where("later").select("x", "y").mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count("y").alias("n"), F.sum("y").alias("s")).toPandas().sort_values("bin")
    if counts.empty:  # too few rows for a calibration part: the raw scores, clipped
        grid, fitted = np.array([0, BINS - 1]), np.array([0.0, 1.0])
    else:
        grid, fitted = isotonic(counts["bin"].to_numpy(), counts["n"].to_numpy(float), (counts["s"] / counts["n"]).to_numpy())

    def calibrated(batches):
        for batch in batches:
            score = np.interp(bin_of(raw(batch.column(1))), grid, fitted)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return out.mapInArrow(calibrated, "doc_id long, held_out boolean, score double, predicted int")


def fold(n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels, fold(5) == 0, fold(5) == 4)


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted to be of quality 1."""
    bad = quality_scores(docs, labels).where("predicted = 0").select(F.col("doc_id").alias("_lamella_bad")).distinct()
    return docs.join(bad.hint("merge"), docs["doc_id"] == bad["_lamella_bad"], "left_anti")
