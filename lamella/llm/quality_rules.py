"""Rule counts and perplexity bands: a modified Kneser-Ney model over byte n-grams, counted by Spark.

A gram is up to ORDER bytes of UTF-8, none folded, packed into one number with its length in front, so keys are
exact. Each task sums its texts' grams of the highest order, Spark sums them by (language, gram); the lower orders
are groupings of these tables by suffix. Range-sorted by language and key, the grams that share a context lie next
to each other (256 at most), so a window gives their shares and the context's back-off, and the same tasks write
them as files of at most SHARD sorted entries into the shared folder; no task holds a language, and nothing is
joined. Grams seen fewer than MIN_COUNT times are left to the lower orders (their mass is the context's back-off),
else a rare string would vouch for itself. The model grows with the corpus. Scoring tasks take the documents CHUNK
bytes at a time, look their distinct grams up shard by shard, from the shortest to the longest, and hold CACHE shards
at most: neither broadcast nor memory grows with the model. A document's log perplexity must lie in its language's
band: BAND interquartile ranges about the quartiles of the documents that pass the base rules.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window as W, functions as F

from . import kernels as K
from .common import scratch, small_side, stored

ORDER = 6
#: The byte that stands before a text's start (no byte of UTF-8).
PAD = 0xFF
MIN_COUNT = 2
#: Interquartile ranges below the lower and above the upper quartile of log perplexity, and the least margin in nats a
#: byte. Texts that stand in the corpus many times have a low perplexity and are not bad for it, so that side is wider.
BAND, LEAST = (3.0, 2.0), 0.02
#: Entries of a shard (12 bytes each), shards that a worker keeps, bytes of text that are scored at a time.
SHARD, CACHE, CHUNK = 1 << 20, 16, 2 << 20
#: Grams that a counting task holds before it sends what it has.
HELD = 6 << 20

_LENGTH = 48  # the bits below hold the bytes, those above the gram's length
_CONTEXT = 1 << 52  # marks the key of a context


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The packed ORDER bytes that end at each byte; what lies before a row's start is PAD."""
    code = data.astype(np.int64)
    for lag in range(1, ORDER):
        before = np.full(len(data), PAD, np.int64)
        before[lag:] = data[: max(len(data) - lag, 0)]
        for t in range(lag):
            at = offsets[:-1] + t
            before[at[at < offsets[1:]]] = PAD
        code |= before << (8 * lag)
    return code


def _counts(batches):
    """(lang, text) -> (lang, code, n), summed over the task (in steps that bound what is kept)."""
    held: dict[str, list] = {}

    def squeeze(parts):
        codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        at = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
        return codes[at], np.add.reduceat(n, at)

    def out(lang, codes, n):
        for low in range(0, len(codes), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes[part])), pa.array(codes[part]), pa.array(n[part])], names=["lang", "code", "n"])

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for row, data, offsets in K.pieces(batch.column(1)):
            code, lengths = grams(data, offsets), np.diff(offsets)
            here = langs[row : row + len(lengths)]
            for lang in set(here.tolist()):
                own = code[np.repeat(here == lang, lengths)]
                if len(own):
                    held.setdefault(lang, []).append(np.unique(own, return_counts=True))
            if sum(len(p[0]) for parts in held.values() for p in parts) > HELD:
                held = {lang: [squeeze(parts)] for lang, parts in held.items()}
                while sum(len(parts[0][0]) for parts in held.values()) > HELD // 2:
                    lang = max(held, key=lambda x: len(held[x][0][0]))
                    yield from out(lang, *held.pop(lang)[0])
    for lang, parts in held.items():
        yield from out(lang, *squeeze(parts))


def _discounts(of: DataFrame) -> DataFrame:
    """(l, d1, d2, d3): the three modified discounts of a language, of of(lang, c)."""
    n = [F.count_if(F.col("c") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    part = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(0.9 * i), i - (i + 1) * y * F.col(f"n{i + 1}") / F.greatest(F.col(f"n{i}"), F.lit(1.0)))).alias(f"d{i}")
    return of.groupBy("lang").agg(*n).select(F.col("lang").alias("l"), part(1), part(2), part(3))


def kneser_ney(counts: DataFrame, folder: str, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, path, low, high) of the shards that hold the model of counts(lang, code, n), written into folder.

    c is the count of a highest gram and, below, the number of different bytes before it; raw is how often a gram
    occurs, and only those of raw >= min_count are kept (single bytes all). A gram's entry is its discounted share of
    its context, a context's is what it leaves to the lower order; what pruned grams had is left too. Single bytes
    leave theirs to 1 / 256.
    """
    own, done = stored(counts.select("lang", "code", F.col("n").alias("raw")), "grams"), None
    for order in range(ORDER, 0, -1):
        c = F.col("raw") if order == ORDER else F.col("c")
        table = own.select("lang", "code", "raw", c.alias("c"))
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        live = (F.col("raw") >= min_count) | F.lit(order == 1)
        shares = table.join(F.broadcast(_discounts(table)), F.col("lang") == F.col("l"))  # a row a language
        shares = shares.select("lang", "code", F.shiftright("code", 8).alias("ctx"), "c", F.when(live, F.col("c") - d).alias("mass"))
        alike = W.partitionBy("lang", "ctx")
        ranged = shares.repartitionByRange("lang", "ctx").sortWithinPartitions("lang", "ctx", "code")
        shares = ranged.withColumn("total", F.sum("c").over(alike)).withColumn("left", 1 - F.coalesce(F.sum("mass").over(alike), F.lit(0.0)) / F.col("total"))
        rows = shares.select("lang", "code", (F.col("mass") / F.col("total")).alias("share"), "ctx", "left")
        part = stored(rows.mapInArrow(_written(folder, order), "lang string, path string, low long, high long"), "shards")
        done = part if done is None else done.unionByName(part)
        if order > 1:
            suffix = F.col("code").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1)).alias("code")
            own = stored(own.groupBy("lang", suffix).agg(F.sum("raw").alias("raw"), F.count(F.lit(1)).alias("c")), "grams")
    return done


def _written(folder: str, order: int):
    """(lang, code, share, ctx, left), sorted -> (lang, path, low, high): writes shards, each of one language and a range of keys."""

    def run(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        open_: dict[int, list] = {0: [], 1: []}  # pieces (keys, values) of grams and of contexts
        lang = None

        def finished(kind):
            if open_[kind]:
                keys, values = (np.concatenate(c) for c in zip(*open_[kind]))
                open_[kind] = []
                if not len(keys):  # all grams of these pieces were pruned
                    return
                name = f"{uuid.uuid4().hex}.parquet"
                with fs.open_output_stream(f"{root}/{name}") as out:
                    pq.write_table(pa.table([pa.array(keys), pa.array(values.astype(np.float32))], names=["key", "value"]), out, compression="none", use_dictionary=False)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([name]), pa.array(keys[:1]), pa.array(keys[-1:])], names=["lang", "path", "low", "high"])

        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            code, ctx = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            share, left = batch.column(2).to_numpy(zero_copy_only=False), batch.column(4).to_numpy()
            for part in np.split(np.arange(len(names)), np.flatnonzero(names[1:] != names[:-1]) + 1) if len(names) else ():
                if names[part[0]] != lang:
                    yield from finished(0)
                    yield from finished(1)
                    lang, last = names[part[0]], None
                live = part[~np.isnan(share[part])]
                new = part[np.diff(ctx[part], prepend=ctx[part[:1]] - 1 if last is None else [last]) != 0]
                last = ctx[part[-1]]
                open_[0].append((code[live] + (order << _LENGTH), share[live]))
                open_[1].append((ctx[new] + (order << _LENGTH) + _CONTEXT, left[new]))
                for kind in (0, 1):
                    if sum(len(p[0]) for p in open_[kind]) >= SHARD:
                        yield from finished(kind)
        yield from finished(0)
        yield from finished(1)

    return run


class Shards:
    """The shards of a model in a folder, of which the CACHE used last are kept."""

    def __init__(self, folder: str, index: dict[str, list[tuple[int, int, str]]]):
        self.folder, self.index, self.held = folder, index, OrderedDict()

    def read(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name in self.held:
            self.held.move_to_end(name)
        else:
            fs, root = pyarrow.fs.FileSystem.from_uri(self.folder)
            with fs.open_input_file(f"{root}/{name}") as source:
                found = pq.read_table(source)
            self.held[name] = tuple(found[c].combine_chunks().to_numpy() for c in ("key", "value"))
            while len(self.held) > CACHE:
                self.held.popitem(last=False)
        return self.held[name]

    def find(self, lang: str, keys: np.ndarray, missing: float) -> np.ndarray:
        """The values of ascending keys; `missing` for those without an entry."""
        out = np.full(len(keys), missing)
        for low, high, name in self.index.get(lang, ()):
            a, b = np.searchsorted(keys, [low, high + 1])
            if a < b:
                own, value = self.read(name)
                at = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
                out[a:b] = np.where(own[at] == keys[a:b], value[at], missing)
        return out

    def probability(self, lang: str, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of the last byte of each packed gram (ascending) after the others: its share, and what the context leaves times
        the probability after one byte less. An unknown context leaves all."""
        if order == 0:
            return np.full(len(codes), 1 / 256)
        shorter, back = np.unique(codes & ((1 << (8 * (order - 1))) - 1), return_inverse=True)
        contexts, of = np.unique(codes >> 8, return_inverse=True)
        left = self.find(lang, contexts + (order << _LENGTH) + _CONTEXT, 1.0)[of]
        return self.find(lang, codes + (order << _LENGTH), 0.0) + left * self.probability(lang, shorter, order - 1)[back]


def model_of(counts: DataFrame, min_count: int = MIN_COUNT) -> Shards:
    """The model of counts(lang, code, n); what reaches the driver is a row a shard."""
    folder = scratch(counts.sparkSession, "model")
    if "://" not in folder and not folder.startswith("/"):
        folder = f"/{folder}"
    index: dict[str, list[tuple[int, int, str]]] = {}
    for r in kneser_ney(counts, folder, min_count).collect():
        index.setdefault(r["lang"], []).append((r["low"], r["high"], r["path"]))
    return Shards(folder, {lang: sorted(found) for lang, found in index.items()})


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _rules(shared):
    def judged(model: Shards, batch: pa.RecordBatch):
        langs = np.array(batch.column(1).to_pylist(), object)
        for row, data, offsets in K.pieces(batch.column(2), CHUNK):
            lengths = np.diff(offsets)
            here = langs[row : row + len(lengths)]
            code = grams(data, offsets)
            logs = np.zeros(len(code))
            for lang in set(here.tolist()):
                own = np.repeat(here == lang, lengths)
                codes, inverse = np.unique(code[own], return_inverse=True)
                logs[own] = np.log(model.probability(lang, codes))[inverse]
            total = np.zeros(len(logs) + 1)
            np.cumsum(logs, out=total[1:])
            mean = -np.diff(total[offsets]) / np.maximum(lengths, 1)
            counts = K.base_counts(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(lengths)), pa.array(here.tolist(), pa.string()), *[pa.array(counts[c], pa.int64()) for c in COUNTS], pa.array(mean, mask=lengths == 0)],
                names=["doc_id", "lang", *COUNTS, "log_perplexity"],
            )

    def run(batches):
        folder, index = shared.value
        model, held, size = Shards(folder, index), [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(2).nbytes
            if size >= CHUNK:
                yield from judged(model, pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size = [], 0
        held = [b for b in held if b.num_rows]
        if held:
            yield from judged(model, pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def perplexities(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(doc_id, lang, counts, log_perplexity) of docs(doc_id, text, lang), stored; a null lang stays null."""
    texts = docs.select("doc_id", F.concat(F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce("lang", F.lit(""))).alias("lang"), "text")
    counted = texts.select("lang", "text").mapInArrow(_counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    model = model_of(counted, min_count)
    shared = docs.sparkSession.sparkContext.broadcast((model.folder, model.index))  # a row a shard of SHARD grams
    fields = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", log_perplexity double"
    found = texts.select(F.col("doc_id").cast("long"), "lang", "text").mapInArrow(_rules(shared), fields)
    return stored(found.withColumn("lang", F.when(F.col("lang") != "-", F.substring("lang", 2, 1 << 30))), "judged")


def quality_rules(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity) of each row.

    docs(doc_id, text, lang): a null lang is a language of its own, an empty one another; a null text has no words, no
    perplexity, and fails the base rules. log_perplexity is in nats a byte. kept: not base_failed, and the log perplexity
    lies in the language's band (a language all of whose documents fail has none, and they are not kept anyway). Repeated
    rows count as often in the corpus and are judged alike. An empty table gives no rows. Extra columns are ignored.
    """
    judged = perplexities(docs).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    quartiles = judged.where("not base_failed").groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 10000).alias("q"))
    low, high = (F.greatest(F.lit(b) * (F.col("q")[1] - F.col("q")[0]), F.lit(LEAST)) for b in band)
    bands = quartiles.select(F.col("lang").alias("l"), (F.col("q")[0] - low).alias("low"), (F.col("q")[1] + high).alias("high"))
    out = judged.join(small_side(bands), F.col("lang").eqNullSafe(F.col("l")), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return out.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "log_perplexity")
