"""Near-duplicate groups: many universal hash minima, banding, signature check, exact check, star components.

Plan. One pass over the texts gives each document the digest of its shingle set and, for sets that are not
empty, HASHES universal-hash minima. Equal sets collapse to one numbered row before anything is joined, so
exact copies cost one row each. Band keys are counted; only members of buckets with company go on. A small
bucket is joined pairwise; a large one (many near copies) is joined to its most central member only, the one
that shares most large buckets, which links almost all of a group of copies without all its pairs. Candidates
pass a loose signature check and then the exact one on whole sets.

What a star leaves in different components of one large bucket is banded again, by longer rows (FINER) of
minima taken from its whole sets: unlike members, which shared a short band, part there, so the pairs that are
compared are those likely to be links. Sets too few of whose shingles any other of these sets has can't be linked
with one of them, and leave first. Buckets that are still large and of several components after their star are
compared in blocks inside tasks, where only links come out; buckets that share members are one group there if that
deals fewer rows. So every pair that shares a bucket in the first banding has shared one in the second (but for the
misses stated there), been tested, been ruled out by its shingles, or lies in one component.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from . import kernels as K
from .common import restricted, small_side, stored
from .components import components


@dataclass(frozen=True)
class Banding:
    """hashes minima in bands of `rows`; a candidate's sets are compared if at least `agree` minima are equal.

    agree lies 5 standard deviations below 0.8 * hashes.
    """

    hashes: int
    rows: int
    agree: int


#: 32 bands of 4 miss a pair of similarity 0.8 with probability (1 - 0.8**4)**32 = 5e-8.
DOCUMENTS = Banding(128, 4, 79)
#: 96 bands of 8, for members of large buckets that their star left apart; a pair is missed with probability 2e-8.
FINER = Banding(768, 8, 559)
SMALL_BUCKET = 12
#: Sets in a block of the last comparison.
BLOCK = 128

_rng = np.random.default_rng(20240613)
_A = _rng.integers(0, 1 << 64, FINER.hashes, np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 64, FINER.hashes, np.uint64)
_C = _rng.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)


def signatures(sets: list[np.ndarray], hashes: int = DOCUMENTS.hashes) -> np.ndarray:
    """The minima (32 bits of multiply-shift) of each non-empty set."""
    at = np.cumsum([0, *map(len, sets[:-1])])
    x = K.mix(np.concatenate(sets))
    out = np.empty((len(sets), hashes), np.uint32)
    for j in range(hashes):
        out[:, j] = np.minimum.reduceat(x * _A[j] + _B[j], at) >> np.uint64(32)
    return out


def bands(sigs: np.ndarray, rows: int) -> np.ndarray:
    n = sigs.shape[1] // rows
    parts = sigs[:, : n * rows].reshape(len(sigs), n, rows).astype(np.uint64)
    return K.mix((K.mix(parts) * _C[:rows]).sum(axis=2, dtype=np.uint64) + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def digest(s: np.ndarray) -> bytes:
    """The key of a sorted set."""
    return xxhash.xxh3_128_digest(s.tobytes())


def _features(k: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row, data, offsets in K.pieces(texts):
                sets = list(K.shingles(data, offsets, k))
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full]) if full else None
                keys, minima = [None] * len(sets), [None] * len(sets)
                for i, s in zip(full, sig if full else ()):
                    keys[i], minima[i] = digest(sets[i]), s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(minima, pa.binary())],
                    names=["id", "n", "set_key", "minima"],
                )

    return run


def _minima(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, hashes)


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _unpacked(how: Banding):
    """(rep, minima) -> (bucket, rep), a row for each band."""

    def run(batches):
        for batch in batches:
            keys = bands(_minima(batch.column(1), how.hashes), how.rows)
            reps = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(reps)], names=["bucket", "rep"])

    return run


def _unpacked_sets(how: Banding):
    """(shingles, rep, further longs) -> (bucket, rep, further longs), a row for each band of the set's minima."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                keys = bands(signatures(_arrays(part.column(0)), how.hashes), how.rows)
                others = [pa.array(np.repeat(x.to_numpy(), keys.shape[1])) for x in part.columns[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *others], names=["bucket", *part.schema.names[1:]])

    return run


def _held(batches):
    """(rep, shingles) -> (h, rep, n): the shingles of some sets, one set that holds each, and how many do."""
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            sets = _arrays(part.column(1))
            h, at, n = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
            rep = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])[at]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(rep), pa.array(n)], names=["h", "rep", "n"])


def _agreeing(how: Banding):
    """Keeps candidate pairs of which enough minima are equal."""

    def run(batches):
        for batch in batches:
            a, b = (_minima(batch.column(c), how.hashes) for c in (2, 3))
            ok = pa.array((a == b).sum(axis=1) >= how.agree)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    same = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * same >= percent * (len(a) + len(b) - same)


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            ok = pa.array([_similar(a, b, percent) for a, b in zip(_arrays(batch.column(2)), _arrays(batch.column(3)))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["u", "v"])

    return run


def _blocks(percent: int, how: Banding):
    """Links between sets of different components, of a stray block and another block."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        rep, component, side = (rows[c].to_numpy() for c in ("rep", "component", "side"))
        sig, sets = _minima(rows["minima"], how.hashes), _arrays(rows["shingles"])
        root = {c: c for c in component.tolist()}  # as links are found, further pairs of the two components are no longer needed

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        u, v = [], []
        for i in np.flatnonzero(side == 0):
            others = np.flatnonzero((component != component[i]) & ((sig == sig[i]).sum(axis=1) >= how.agree))
            others = others[(side[others] == 1) | (rep[others] < rep[i])]
            for j in others[np.argsort(component[others], kind="stable")]:
                a, b = top(int(component[i])), top(int(component[j]))
                if a != b and _similar(sets[i], sets[j], percent):
                    root[a] = b
                    u.append(rep[i])
                    v.append(rep[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _shared(slots: DataFrame) -> DataFrame:
    """slots(bucket, rep) of buckets with company, with their size, stored."""
    sizes = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return stored(slots.join(sizes, "bucket"), "members")


def _stars(members: DataFrame) -> DataFrame:
    """(bucket, rep, pivot) of the large buckets and their most central member."""
    large = members.where(F.col("size") > SMALL_BUCKET).select("bucket", "rep")
    central = large.withColumn("c", F.count(F.lit(1)).over(W.partitionBy("rep")))  # at most a row a band
    pivots = central.groupBy("bucket").agg(F.max(F.struct("c", "rep")).alias("m")).select("bucket", F.col("m.rep").alias("pivot"))
    return stored(large.join(pivots, "bucket"), "large")


def _pairs(members: DataFrame, stars: DataFrame) -> DataFrame:
    """The candidate pairs (a, b), a < b: all of small buckets, those with the pivot of large ones."""
    small = members.where(F.col("size") <= SMALL_BUCKET)
    extra = [c for c in members.columns if c == "component"]
    a, b = (small.select("bucket", F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in extra]) for x in "ab")
    pairs = a.join(b, "bucket").where("a < b" + (" and component_a <> component_b" if extra else "")).select("a", "b")
    stars = stars.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
    return pairs.unionByName(stars).distinct()


def _open(stars: DataFrame, roots: DataFrame) -> DataFrame | None:
    """(bucket, rep, component) of the members of the large buckets in stars(bucket, rep, pivot) that lie in several
    components, stored; None if there are none.

    The pairs with a pivot are looked at first, each once whatever the number of buckets that two sets share.
    """
    own = lambda c, out: roots.select(F.col("node").alias(c), F.col("component").alias(out))
    pairs = stars.where("rep <> pivot").select("rep", "pivot").distinct()
    apart = pairs.join(own("rep", "c"), "rep", "left").join(own("pivot", "d"), "pivot", "left").where(F.coalesce("c", "rep") != F.coalesce("d", "pivot"))
    apart = stored(apart.select("rep", "pivot"), "apart")
    if apart.isEmpty():
        return None
    buckets = stored(stars.join(small_side(apart), ["rep", "pivot"], "left_semi").select("bucket").distinct(), "mixed")
    members = stars.drop("pivot").join(small_side(buckets), "bucket", "left_semi")
    return stored(members.join(own("rep", "c"), "rep", "left").select(*members.columns, F.coalesce("c", "rep").alias("component")), "open")


def _merged(links: DataFrame, roots: DataFrame) -> DataFrame:
    return components(links.unionByName(roots.select(F.col("node").alias("u"), F.col("component").alias("v"))))


def _compared(pairs: DataFrame, signed: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, how: Banding) -> DataFrame:
    """The links (u, v) among the pairs (a, b)."""
    a = signed.select(F.col("rep").alias("a"), F.col("minima").alias("ma"))
    b = signed.select(F.col("rep").alias("b"), F.col("minima").alias("mb"))
    likely = stored(pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb").mapInArrow(_agreeing(how), "a long, b long"), "likely")
    sets = sets_of(likely.select(F.explode(F.array("a", "b")).alias("rep")))
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return likely.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_linked(percent), "u long, v long")


def _common(sets: DataFrame) -> DataFrame:
    """(rep, k, c) of sets(rep, shingles): the size, and how many shingles another of the sets holds too. Stored."""
    held = sets.select("rep", "shingles").mapInArrow(_held, "h long, rep long, n long")
    only = held.groupBy("h").agg(F.sum("n").alias("n"), F.max("rep").alias("rep")).where("n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("u"))
    sizes = sets.select("rep", (F.octet_length("shingles") / 8).cast("long").alias("k"))
    return stored(sizes.join(only, "rep", "left").select("rep", "k", (F.col("k") - F.coalesce("u", F.lit(0))).alias("c")), "common")


def _finer(open_: DataFrame, roots: DataFrame, signed: DataFrame, with_sets: Callable[[DataFrame], DataFrame], percent: int, how: Banding) -> DataFrame:
    """roots after members of large buckets that lie in several components have been banded again and compared.

    Sets of k and l shingles have at most min(c, d) in common, if c and d of them are held by other sets too, and are
    linked if (100 + percent) * common >= percent * (k + l). So those that can't be linked even with the smallest set of
    a bucket leave it before its pivot is chosen: what its star leaves apart is all there is to compare.
    """
    sets = with_sets(open_.select("rep"))
    common = _common(sets)
    able = common.where(100 * F.col("c") >= percent * F.col("k"))  # else not linked with any l
    placed = sets.join(able, "rep").join(open_.select("rep", "component").distinct(), "rep")
    placed = placed.select("shingles", "rep", "component", F.col("k").alias("n_shingles"), F.col("c").alias("n_common"))
    slots = stored(placed.mapInArrow(_unpacked_sets(FINER), "bucket long, rep long, component long, n_shingles long, n_common long"), "slots")
    mixed = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("n_shingles").alias("least"))
    able = (100 + percent) * F.col("n_common") >= percent * (F.col("n_shingles") + F.col("least"))
    members = slots.join(mixed.where("low < high").select("bucket", "size", "least"), "bucket").where(able)
    members = stored(members.select("bucket", "rep", "component", "size"), "finer")
    stars = _stars(members)
    roots = _merged(stored(_compared(_pairs(members, stars), signed, lambda ids: sets, percent, how), "links"), roots)
    left = _open(stars, roots)
    return roots if left is None else _merged(_block_links(_grouped(left), sets, signed, percent, how), roots)


def _dealt_rows(groups: DataFrame, key: str) -> DataFrame:
    """(key, main, strays, mains, rows) of groups(key, component, n): the largest component, the numbers of blocks outside
    and inside it, and how many rows the comparison in blocks deals."""
    sizes = groups.groupBy(key).agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"))
    others = F.col("n_all") - F.col("n_main")
    sizes = sizes.withColumn("strays", F.ceil(others / BLOCK)).withColumn("mains", F.ceil(F.col("n_main") / BLOCK))
    return sizes.select(key, "main", "strays", "mains", (others * (F.col("strays") + F.col("mains")) + F.col("n_main") * F.col("strays")).alias("rows"))


def _grouped(open_: DataFrame) -> DataFrame:
    """open_(bucket, rep, component) with the buckets that are connected by members as one, where that deals fewer rows."""
    heads = stored(open_.groupBy("bucket").agg(F.min("rep").alias("head")), "heads")
    links = open_.join(small_side(heads), "bucket").where("rep <> head").select(F.col("rep").alias("u"), F.col("head").alias("v")).distinct()
    hoods = components(stored(links, "shared")).select("node", F.col("component").alias("hood"))
    members = stored(open_.select("rep", "component").distinct().join(hoods, F.col("rep") == F.col("node")).select("hood", "rep", "component"), "hoods")
    whole = _dealt_rows(members.groupBy("hood", "component").agg(F.count(F.lit(1)).alias("n")), "hood").select("hood", F.col("rows").alias("whole"))
    single = _dealt_rows(open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")), "bucket").select("bucket", "rows")
    single = stored(single.join(heads, "bucket").join(hoods, F.col("head") == F.col("node")).select("hood", "bucket", "rows"), "single")
    joined = single.groupBy("hood").agg(F.sum("rows").alias("rows")).join(whole, "hood").where("whole <= rows").select("hood")
    joined = stored(joined, "joined")
    apart = single.join(joined, "hood", "left_anti").select("bucket")
    return stored(members.join(joined, "hood").select(F.col("hood").alias("bucket"), "rep", "component").unionByName(open_.join(apart, "bucket", "left_semi")), "groups")


def _block_links(open_: DataFrame, sets: DataFrame, signed: DataFrame, percent: int, how: Banding) -> DataFrame:
    """Links (u, v) within the buckets of open_(bucket, rep, component): blocks of strays against all other blocks of the bucket."""
    sizes = _dealt_rows(open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")), "bucket")
    open_ = open_.join(sizes, "bucket")
    side = (F.col("component") == F.col("main")).cast("int")  # 1: the bucket's largest component
    strays, mains = F.col("strays").cast("int"), F.col("mains").cast("int")
    block = F.pmod(F.xxhash64("rep"), F.when(side == 1, mains).otherwise(strays)).cast("int")
    open_ = open_.select("rep", "bucket", "component", side.alias("side"), strays.alias("strays"), mains.alias("mains"), block.alias("block"))
    # Blocks (a, b): a of strays, b of strays (a <= b) or, from `far` on, of the main component.
    far = F.lit(1 << 40)
    own = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda o: F.struct(F.least(o, F.col("block")).cast("long").alias("a"), F.greatest(o, F.col("block")).cast("long").alias("b"), F.when(o < F.col("block"), 1).otherwise(0).alias("s")))
    to_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda o: F.struct(F.col("block").cast("long").alias("a"), (far + o).alias("b"), F.lit(0).alias("s")))
    to_stray = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda o: F.struct(o.cast("long").alias("a"), (far + F.col("block")).alias("b"), F.lit(1).alias("s")))
    pairs = F.explode(F.when(F.col("side") == 1, to_stray).otherwise(F.concat(own, to_main)))
    dealt = open_.select("rep", "bucket", "component", pairs.alias("p")).select("rep", "component", "bucket", "p.a", "p.b", F.col("p.s").alias("side"))
    full = dealt.join(sets, "rep").join(signed.select("rep", "minima"), "rep").select("rep", "component", "minima", "shingles", "bucket", "a", "b", "side")
    return stored(full.groupBy("bucket", "a", "b").applyInArrow(_blocks(percent, how), "u long, v long"), "links")


def linked_components(signed: DataFrame, with_sets: Callable[[DataFrame], DataFrame], percent: int, how: Banding) -> DataFrame:
    """(node, component) of the sets in signed(rep long, minima) that are linked with another.

    with_sets(ids(rep)) gives (rep, shingles), the sorted 64-bit hashes of the wanted sets, stored.
    """
    members = _shared(signed.select("rep", "minima").mapInArrow(_unpacked(how), "bucket long, rep long"))
    stars = _stars(members)
    roots = components(_compared(_pairs(members, stars), signed, with_sets, percent, how))
    open_ = _open(stars, roots)
    return roots if open_ is None else _finer(open_, roots, signed, with_sets, percent, how)


def _keyed_sets(k: int):
    """(text) -> (set_key, shingles)"""

    def run(batches):
        for batch in batches:
            for _, data, offsets in K.pieces(batch.column(0)):
                sets = [s for s in K.shingles(data, offsets, k) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())], names=["set_key", "shingles"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of docs.

    Documents are linked if the Jaccard similarity of their sets of k-word shingles (A-Z lower-cased) is at
    least percent / 100; rows of one id are one document, linked with all that any of its texts is linked with.
    component_id is the least id reachable; kept marks the rows with that id. Null and word-less texts have no
    shingles and link with nothing. Repeated rows of one id are returned as often as they stand, each with the same
    component. A null id keeps its row, unlinked, with a null component, and is not kept. An empty table gives no
    rows. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = stored(docs.mapInArrow(_features(k), "id long, n long, set_key binary, minima binary"), "minima")
    worded = found.where("set_key is not null and id is not null")
    sets = worded.groupBy("set_key").agg(F.min("minima").alias("minima"), F.min("id").alias("first"), F.max("id").alias("last"))
    signed = stored(sets.withColumn("rep", F.monotonically_increasing_id()), "signed")  # numbered as they are written

    def with_sets(ids: DataFrame) -> DataFrame:
        wanted = stored(signed.select("rep", "set_key", "first").join(ids.select("rep").distinct(), "rep"), "wanted")
        texts = restricted(docs, wanted.select(F.col("first").alias("id")), "id").select("text")
        sets = texts.mapInArrow(_keyed_sets(k), "set_key binary, shingles binary").join(wanted.select("rep", "set_key"), "set_key")
        return stored(sets.select("rep", "shingles").dropDuplicates(["rep"]), "sets")

    roots = linked_components(signed, with_sets, percent, DOCUMENTS)
    numbered = worded.select("id", "set_key").join(signed.select("set_key", "rep"), "set_key").select("id", "rep")
    several = numbered.groupBy("id").agg(F.min("rep").alias("u"), F.max("rep").alias("w")).where("u < w")  # ids of several texts
    several = stored(several.select("id", "u"), "several")
    if not several.isEmpty():
        roots = _merged(numbered.join(several, "id").select(F.col("u"), F.col("rep").alias("v")).where("u <> v").distinct(), roots)
    least = roots.join(signed.select("rep", "first"), F.col("node") == F.col("rep")).groupBy("component").agg(F.min("first").alias("least"))
    of_rep = roots.join(least, "component").select(F.col("node").alias("rep"), "least")
    of_set = signed.select("set_key", "rep", "first", "last").join(of_rep, "rep", "left").where("least is not null or first < last").select("set_key", F.coalesce("least", "first").alias("component"))
    out = found.select("id", "n", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def kept_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each near-duplicate group, its columns unchanged.

    Rows with a null id are kept (they are in no group); of the rows of a kept id, the one of the least text stays (of
    equal texts, of the least hash of the other columns).
    """
    groups = near_duplicates(docs, k=k, percent=percent)
    keep = groups.where("kept").select(F.col("id").alias("_lamella_kept")).distinct()
    others = [c for c in docs.columns if c != "text" and "map" not in docs.schema[c].dataType.simpleString()]
    row = F.min_by(F.struct(*docs.columns), F.struct("text", F.xxhash64(*others))).alias("_lamella_row")
    # A merge join at every size: the ids kept are a share of the rows, not a small table.
    known = docs.where(docs["doc_id"].isNotNull()).join(keep.hint("merge"), docs["doc_id"] == keep["_lamella_kept"], "left_semi")
    known = known.groupBy(F.col("doc_id").alias("_lamella_id")).agg(row).select("_lamella_row.*")
    return known.unionByName(docs.where(docs["doc_id"].isNull()))
