"""Substring dedup: paragraphs that repeat across documents, by MinHash banding, exact Jaccard and components.

A paragraph is a line; a line of more than LONG words is cut at sentence ends chosen by the sentence's own
hash, so that a passage inside it is cut alike wherever it stands. Paragraphs of at least MIN_WORDS words get
the digest of their set of SHINGLE-word shingles and a few minima; equal sets collapse before anything is joined,
colliding ones are joined and confirmed on whole sets, and components give the clusters.

A passage that repeats inside otherwise different lines is found through units that content alone places: of the
hashes of ANCHOR consecutive words, the least among those of a run of PASSAGE words is the run's anchor, the same in
every copy. Anchors that several documents hold name the candidates (a band of all rows, as copies of a unit are
equal); the runs about an anchor are compared by one hash of them all first, so equal surroundings cost one row,
and by the hash of each run where surroundings differ. What is found is exactly what repeats, over line ends too.

Spans are word numbers (a word: a run of other than ASCII white space), so they hold for any encoding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K
from .common import BITMAP_BITS, bitmap, is_set, restricted, small_side, stored
from .minhash import Banding, digest, linked_components, signatures

MIN_WORDS = 25
LONG = 100
SHINGLE = 5
#: 12 bands of 3 miss a pair of similarity 0.8 with probability (1 - 0.8**3)**12 = 2e-4; agree: 5 standard deviations below.
PARAGRAPHS = Banding(36, 3, 16)

#: Words of the least passage, and of an anchor; a run of PASSAGE words holds WINDOW places for one.
PASSAGE, ANCHOR = 51, 13
WINDOW = PASSAGE - ANCHOR + 1

_ENDS = K._flags(".!?")
_PLACE = np.uint64((1 << 24) - 1)


class Cut:
    """The words of some rows and their paragraphs: paragraph p is the words first[p] to first[p + 1], all of one row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.row_first, self.h = K.words(data, offsets, lower=True)
        n = len(self.h)
        begin, _, _ = K.runs(data != 10, offsets)
        line = np.searchsorted(begin, starts, "right")
        new = np.diff(line, prepend=-1) != 0
        if n:
            size = np.bincount(line, minlength=line[-1] + 1)
            # A sentence end in a long line is a cut if the hash of the word before it says so (one of 4).
            closes = _ENDS[data[ends[:-1] - 1]] & (self.h[:-1] % K.U(4) == 0)
            new[1:] |= closes & (size[line[1:]] > LONG)
        self.first = np.append(np.flatnonzero(new), n)
        self.row = np.searchsorted(self.row_first, self.first[:-1], "right") - 1
        self.size = np.diff(self.first)

    def sets(self, chosen: np.ndarray) -> list[np.ndarray]:
        """The shingle sets of the chosen paragraphs."""
        sizes = self.size[chosen]
        at = np.concatenate([[0], np.cumsum(sizes)])
        own = self.h[np.arange(at[-1]) - np.repeat(at[:-1], sizes) + np.repeat(self.first[chosen], sizes)]
        return list(K.shingles_of(own, at, SHINGLE))


def _found(min_words: int, hashes: int):
    """(doc_id, text) -> a row for each paragraph of at least min_words words."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, offsets in K.pieces(batch.column(1)):
                cut = Cut(data, offsets)
                chosen = np.flatnonzero(cut.size >= min_words)
                sets = cut.sets(chosen)
                if not sets:
                    continue
                row = cut.row[chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + row], pa.int64()), pa.array(cut.first[chosen] - cut.row_first[row], pa.int64()), pa.array(cut.size[chosen], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in signatures(sets, hashes)], pa.binary())],
                    names=["doc_id", "start", "n_words", "set_key", "minima"],
                )

    return run


def _place(key: bytes) -> int:
    return int.from_bytes(key[:4], "big") % BITMAP_BITS


def _wanted(min_words: int, flags):
    """(text) -> (set_key, shingles) of the paragraphs whose digest's place is set; all of them without flags."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in K.pieces(batch.column(0)):
                cut = Cut(data, offsets)
                sets = cut.sets(np.flatnonzero(cut.size >= min_words))
                keys = [digest(s) for s in sets]
                if flags is not None and keys:
                    ok = is_set(flags.value, np.array([_place(x) for x in keys]))
                    keys, sets = [x for x, y in zip(keys, ok) if y], [x for x, y in zip(sets, ok) if y]
                first = dict(zip(keys, sets))
                yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.binary()), pa.array([s.tobytes() for s in first.values()], pa.binary())], names=["set_key", "shingles"])

    return run


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = 80) -> DataFrame:
    """(doc_id, start, n_words, cluster_doc_id, cluster_start, removed): paragraphs found in several documents.

    Paragraphs are linked if the Jaccard similarity of their shingle sets is at least percent / 100; clusters are the
    components, and those within one document are left out. The cluster's paragraph of the least doc_id (and start) is
    kept, the others are removed. start is the number of the paragraph's first word. Null and empty texts have no
    paragraphs; rows with a null doc_id are ignored; repeated rows of one doc_id are one document. An empty table gives
    no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    found = stored(docs.mapInArrow(_found(min_words, PARAGRAPHS.hashes), "doc_id long, start long, n_words long, set_key binary, minima binary"), "paragraphs")
    sets = found.groupBy("set_key").agg(F.min("minima").alias("minima"), F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last"))
    signed = stored(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")  # numbered as they are written

    def with_sets(ids: DataFrame) -> DataFrame:
        wanted = stored(signed.select("rep", "set_key", F.col("first.doc_id").alias("doc_id")).join(ids.select("rep").distinct(), "rep"), "wanted")
        flags = bitmap(wanted.select(F.expr(f"cast(conv(hex(substring(set_key, 1, 4)), 16, 10) as long) % {BITMAP_BITS}").alias("p")))
        sets = restricted(docs, wanted).select("text").mapInArrow(_wanted(min_words, flags), "set_key binary, shingles binary")
        return stored(sets.join(wanted.select("rep", "set_key"), "set_key").select("rep", "shingles").dropDuplicates(["rep"]), "shingles")

    roots = linked_components(signed.select("rep", "minima"), with_sets, percent, PARAGRAPHS)
    joined = signed.select("set_key", "rep", "first", "last").join(roots, F.col("rep") == F.col("node"), "left").withColumn("cluster", F.coalesce("component", "rep"))
    clusters = joined.groupBy("cluster").agg(F.min("first").alias("least"), F.max("last").alias("most")).where("least.doc_id < most").select("cluster", "least")
    of_set = stored(joined.select("set_key", "cluster").join(clusters, "cluster").select("set_key", "least"), "clusters")
    out = found.select("doc_id", "start", "n_words", "set_key").join(small_side(of_set), "set_key").distinct()
    kept = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("start") == F.col("least.start"))
    return out.select("doc_id", "start", "n_words", F.col("least.doc_id").alias("cluster_doc_id"), F.col("least.start").alias("cluster_start"), (~kept).alias("removed"))


def _least_of_spans(mask: np.ndarray, width: int) -> np.ndarray:
    """The minimum over mask[i : i + width], for each i that has so many."""
    out, have = mask, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


class Runs:
    """All runs of PASSAGE words of some rows, in order, cut into stretches of one anchor each.

    at: first word of each run; stretch s is the runs begin[s] to begin[s + 1]; anchor: hash of its anchor; lead: words
    of its first run before the anchor.
    """

    def __init__(self, h: np.ndarray, row_first: np.ndarray):
        self.total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * K.powers(K._BASE, len(h)), out=self.total[1:])
        self.back = K.powers(K._BASE_INV, len(h) + 1)
        at, first = K.windows(row_first, ANCHOR)
        g = self.hash(at, ANCHOR)
        starts, self.first = K.windows(first, WINDOW)  # places in at; a row has a run for each
        place = np.arange(len(g), dtype=np.uint64)
        # The least hash of a run, the first of equal ones; its place rides in the low bits.
        least = _least_of_spans((g & ~_PLACE) | (place & _PLACE), WINDOW)[starts] if len(starts) else np.zeros(0, np.uint64)
        where = starts + ((least - starts.astype(np.uint64)) & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.diff(where, prepend=-1))
        self.at = at[starts]
        self.begin = np.append(new, len(starts))
        self.row = np.searchsorted(self.first, new, "right") - 1
        self.anchor = g[where[new]]
        self.lead = at[where[new]] - self.at[new]

    def hash(self, at: np.ndarray, n) -> np.ndarray:
        """Hashes of the n words from each of the places at."""
        return K.mix((self.total[at + n] - self.total[at]) * self.back[at] + np.uint64(1) * np.asarray(n).astype(np.uint64))


def _anchored(batches):
    """(doc_id, text) -> (doc_id, h, w): a document's anchors and their first words."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, data, offsets in K.pieces(batch.column(1)):
            _, _, row_first, h = K.words(data, offsets, lower=True)
            runs = Runs(h, row_first)
            own, low = np.unique(runs.row, return_index=True)
            if len(own):
                cut = pa.array([*low, len(runs.row)], pa.int32())
                word = runs.at[runs.begin[:-1]] + runs.lead - row_first[runs.row]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first + own], pa.int64()), *[pa.ListArray.from_arrays(cut, pa.array(x)) for x in (runs.anchor.view(np.int64), word.astype(np.int32))]], names=["doc_id", "h", "w"])


def _outside(cuts, begin: np.ndarray, n: int) -> np.ndarray:
    """Which of the spans of n words from begin meet none of the cuts, sorted (start, n_words) that don't overlap."""
    if not cuts:
        return np.ones(len(begin), bool)
    start = np.array([c["start"] for c in cuts], np.int64)
    stop = start + np.array([c["n_words"] for c in cuts], np.int64)
    return np.searchsorted(stop, begin, "right") == np.searchsorted(start, begin + n, "left")


def _live(batches):
    """(doc_id, h, w, cuts) -> (doc_id, h) of the anchors outside the cuts."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        h, w = (batch.column(c).flatten().to_numpy() for c in (1, 2))
        sizes = batch.column(1).value_lengths().to_numpy()
        at = np.concatenate([[0], np.cumsum(sizes)])
        ok = np.ones(len(h), bool)
        for i in np.flatnonzero(batch.column(3).is_valid().to_numpy(zero_copy_only=False)):
            own = slice(at[i], at[i + 1])
            ok[own] = _outside(batch.column(3)[int(i)].as_py(), w[own].astype(np.int64), ANCHOR)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, sizes)[ok], pa.int64()), pa.array(h[ok])], names=["doc_id", "h"])


def _stretches(batches):
    """(doc_id, text, hs, cuts) -> (h, ctx, doc_id, w, n, runs): the stretches of the wanted anchors, outside the cuts.

    ctx: hash of all words of the stretch and where its anchor lies; w: its first word; n: its runs; runs: the hash of
    each, where this task meets ctx for the first time.
    """
    seen: set[int] = set()
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for first, data, offsets in K.pieces(batch.column(1)):
            _, _, row_first, h = K.words(data, offsets, lower=True)
            runs = Runs(h, row_first)
            out = []
            for r in range(len(offsets) - 1):
                low, high = np.searchsorted(runs.row, [r, r + 1])
                wanted = np.isin(runs.anchor[low:high].view(np.int64), batch.column(2)[first + r].values.to_numpy())
                cuts = batch.column(3)[first + r].as_py()
                for s in (np.flatnonzero(wanted) + low).tolist():
                    a, b = int(runs.begin[s]), int(runs.begin[s + 1])
                    free = np.flatnonzero(_outside(cuts, runs.at[a:b] - row_first[r], PASSAGE)) if cuts else np.arange(b - a)
                    for part in np.split(free, np.flatnonzero(np.diff(free) > 1) + 1) if len(free) else ():
                        out.append((ids[first + r], s, a + part[0], len(part), int(runs.lead[s]) - int(part[0]), r))
            if not out:
                continue
            doc, s, a, n, lead, r = (np.array(x) for x in zip(*out))
            at = runs.at[a]
            ctx = K.mix(runs.hash(at, PASSAGE - 1 + n) ^ K.mix(lead.astype(np.int64).view(np.uint64)) ^ runs.anchor[s]).view(np.int64)
            hashes = []
            for c, x, k in zip(ctx.tolist(), a.tolist(), n.tolist()):
                if c in seen:
                    hashes.append(None)
                else:
                    seen.add(c)
                    hashes.append(runs.hash(runs.at[x : x + k], PASSAGE).tobytes())
            if len(seen) > 1 << 20:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.anchor[s].view(np.int64)), pa.array(ctx), pa.array(doc, pa.int64()), pa.array(at - row_first[r], pa.int64()), pa.array(n, pa.int64()), pa.array(hashes, pa.binary())], names=["h", "ctx", "doc_id", "w", "n", "runs"]
            )


def _each(batches):
    """(ctx, doc_id, w, last, runs) -> (g, ctx, j, doc_id, w, last): the runs of a stretch; w is the run's own place."""
    for batch in batches:
        hashes = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(4)]
        if hashes:
            size = np.array([len(x) for x in hashes])
            j = np.concatenate([np.arange(k) for k in size])
            ctx, doc, w, last = (np.repeat(batch.column(c).to_numpy(), size) for c in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(hashes), ctx, j.astype(np.int32), doc, w + j, last)], names=["g", "ctx", "j", "doc_id", "w", "last"])


def _merged(doc: int, w: np.ndarray, to: np.ndarray, place: np.ndarray) -> list[tuple]:
    """The repeated runs of a document (first words, ascending), each with the first place of its words -> passages.

    Runs that are first themselves stay whole; the others are joined while their first places follow each other too,
    and lose what belongs to a passage that stays or to the passage before.
    """
    first = (to == doc) & (place == w)
    # Runs that stay are one passage as far as they overlap.
    i = np.flatnonzero(first)
    stays = []
    for part in np.split(i, np.flatnonzero(w[i[1:]] > w[i[:-1]] + PASSAGE) + 1) if len(i) else ():
        stays.append((w[part[0]], w[part[-1]] + PASSAGE, part[0]))
    out = [(*s, False) for s in stays]
    i = np.flatnonzero(~first)
    done, k = -1, 0
    breaks = (np.diff(w[i]) != 1) | (np.diff(to[i]) != 0) | (np.diff(place[i]) != 1)
    for part in np.split(i, np.flatnonzero(breaks) + 1) if len(i) else ():
        low, high = w[part[0]], w[part[-1]] + PASSAGE
        past = high
        low = max(low, done)
        while k < len(stays) and stays[k][1] <= low:
            k += 1
        for s in stays[k:]:
            if s[0] >= high:
                break
            if s[0] <= low < s[1]:
                low = s[1]
            elif low < s[0] < high:
                high = s[0]
        done = max(done, past)
        if low < high:
            out.append((low, high, part[0], True))
    return [(doc, a, b - a, to[i], place[i] + a - w[i], removed) for a, b, i, removed in out]


def _passages(batches):
    """(doc_id, w, n, to_doc, to_w), sorted by document and w -> the passages; a document at a time."""
    names = ["doc_id", "start", "n_words", "cluster_doc_id", "cluster_start", "removed"]

    def batch_of(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    def finished(held):
        doc, w, n, to, place = (np.concatenate(c) for c in zip(*held))
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w, to, place = np.repeat(w, n) + j, np.repeat(to, n), np.repeat(place, n) + j
        w, at = np.unique(w, return_index=True)
        return _merged(int(doc[0]), w, to[at], place[at])

    held: list = []
    rows: list = []
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        doc = columns[0]
        for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else ():
            if held and held[0][0][0] != doc[part[0]]:
                rows += finished(held)
                held = []
            held.append([c[part[0] : part[-1] + 1] for c in columns])
        if len(rows) > 10000:
            yield batch_of(rows)
            rows = []
    if held:
        rows += finished(held)
    if rows:
        yield batch_of(rows)


def repeated_passages(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """Equal passages of PASSAGE words (A-Z lower-cased) or more in several documents, outside the removed(doc_id, start, n_words).

    Columns as of repeated_paragraphs. Of each run of PASSAGE words the one of the least doc_id and place stays.
    """
    cuts = stored(removed.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n_words"))).alias("cuts")).withColumnRenamed("doc_id", "cut_id"), "cuts")
    found = docs.mapInArrow(_anchored, "doc_id long, h array<long>, w array<int>")
    # A merge join at every size: after a broadcast one, both functions would hold their workers in the same tasks.
    live = stored(found.join(cuts.hint("merge"), F.col("doc_id") == F.col("cut_id"), "left").select("doc_id", "h", "w", "cuts").mapInArrow(_live, "doc_id long, h long"), "live")
    several = stored(live.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("h"), "several")
    wanted = stored(live.join(small_side(several, 1_000_000), "h").groupBy(F.col("doc_id").alias("wanted_id")).agg(F.collect_set("h").alias("hs")), "anchors")
    texts = restricted(docs, wanted.select(F.col("wanted_id").alias("doc_id")))
    texts = texts.join(wanted, F.col("doc_id") == F.col("wanted_id")).join(cuts, F.col("doc_id") == F.col("cut_id"), "left").select("doc_id", "text", "hs", "cuts")
    seen = stored(texts.mapInArrow(_stretches, "h long, ctx long, doc_id long, w long, n long, runs binary"), "stretches")
    # One row for equal surroundings: where they stand first, and whether another document has them.
    alike = seen.groupBy("h", "ctx").agg(F.min(F.struct("doc_id", "w")).alias("first"), F.max("doc_id").alias("last"), F.max("n").alias("n"))
    alike = stored(alike, "alike")
    mixed = alike.groupBy("h").agg(F.min("ctx").alias("a"), F.max("ctx").alias("b"))
    alone = alike.join(mixed.where("a = b").select("h"), "h").where("first.doc_id < last")
    whole = alone.select("ctx", F.lit(0).cast("long").alias("j"), "n", F.col("first.doc_id").alias("to_doc"), F.col("first.w").alias("to_w"))
    differ = alike.join(mixed.where("a < b").select("h"), "h").select("ctx", "first.doc_id", "first.w", "last")
    hashes = seen.where("runs is not null").select("ctx", "runs").dropDuplicates(["ctx"])
    each = stored(differ.join(hashes, "ctx").select("ctx", "doc_id", "w", "last", "runs").mapInArrow(_each, "g long, ctx long, j int, doc_id long, w long, last long"), "runs")
    owners = each.groupBy("g").agg(F.min(F.struct("doc_id", "w")).alias("first"), F.max("last").alias("last")).where("first.doc_id < last")
    owned = each.select("g", "ctx", "j").join(owners.select("g", F.col("first.doc_id").alias("to_doc"), F.col("first.w").alias("to_w")), "g")
    # Runs of a stretch that follow each other as their first places do are one row.
    spans = owned.groupBy("ctx", "to_doc", (F.col("to_w") - F.col("j")).alias("shift")).agg(F.min("j").cast("long").alias("j"), F.max("j").alias("k"), F.count(F.lit(1)).alias("c"))
    gaps = spans.where("c <> k - j + 1").select("ctx", "to_doc", "shift")
    dense = spans.where("c = k - j + 1").select("ctx", "j", F.col("c").alias("n"), "to_doc", (F.col("shift") + F.col("j")).alias("to_w"))
    sparse = owned.withColumn("shift", F.col("to_w") - F.col("j")).join(gaps, ["ctx", "to_doc", "shift"]).select("ctx", F.col("j").cast("long").alias("j"), F.lit(1).cast("long").alias("n"), "to_doc", "to_w")
    results = stored(whole.unionByName(dense).unionByName(sparse), "results")
    rows = seen.select("ctx", "doc_id", "w").distinct().join(small_side(results), "ctx").select("doc_id", (F.col("w") + F.col("j")).alias("w"), "n", "to_doc", "to_w")
    fields = "doc_id long, start long, n_words long, cluster_doc_id long, cluster_start long, removed boolean"
    return rows.repartition("doc_id").sortWithinPartitions("doc_id", "w").mapInArrow(_passages, fields)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = 80) -> DataFrame:
    """repeated_paragraphs, and repeated_passages of what these do not remove.

    Removed spans of a document don't overlap. A passage that stays has its own place as cluster; of a removed one it
    is where its words stand first. Rows with a null doc_id are ignored; if a doc_id has several texts, what repeats
    between them is not a repeat across documents, and spans that hold for one of them only make no sense of the others.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    lines = stored(repeated_paragraphs(docs, min_words, percent), "lines")
    return lines.unionByName(repeated_passages(docs, lines.where("removed").select("doc_id", "start", "n_words")))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = 80) -> DataFrame:
    """docs with the removed paragraphs and passages cut out of their texts; other rows and columns as they are."""
    cuts = repeats(docs, min_words, percent).where("removed").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n_words"))).alias("_lamella_cuts"))
    joined = docs.join(cuts.withColumnRenamed("doc_id", "_lamella_id"), F.col("doc_id") == F.col("_lamella_id"), "left")

    @F.pandas_udf("string")
    def cut(texts, cuts):
        import pandas as pd

        out = []
        for text, spots in zip(texts, cuts):
            if text is not None and spots is not None:
                data, parts, at = text.encode(), [], 0
                bytes_ = np.frombuffer(data, np.uint8)
                starts, ends, _ = K.runs(~K.SPACE[bytes_], np.array([0, len(data)]))
                for s in spots:
                    parts.append(data[at : starts[s["start"]]])
                    at = int(ends[s["start"] + s["n_words"] - 1])
                text = b"".join([*parts, data[at:]]).decode()
            out.append(text)
        return pd.Series(out, dtype=object)

    return joined.select(*[cut("text", "_lamella_cuts").alias("text") if c == "text" else docs[c] for c in docs.columns])
