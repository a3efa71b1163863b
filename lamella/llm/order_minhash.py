"""Order MinHash fingerprints, with built-in functions only.

A text is cut into tokens: words of at most TOKEN characters with the white space after them, and single characters
of longer runs without white space, so an insertion moves no token boundary but its own. A k-mer is K consecutive
tokens. All k-mers of a text are numbered by occurrence; a hash of (k-mer, occurrence) deals each to one of SKETCHES
sketches and ranks it there. Each sketch keeps the two least of what it was dealt, puts them back in text order and
hashes that ordered pair. Exchanged passages therefore change sketches that a set-based MinHash would leave alone,
and repeated k-mers count as often as they occur. Sketches see disjoint k-mers (one permutation for all of them), and
a pair is equal in two texts if the two least of the k-mers that either text deals to the sketch are common and in one order.

All is done on arrays within a row: a k-mer is one long, its hash above its place in the text, so sorting puts equal
k-mers together in text order. No row per k-mer is made, and only the document's text is shuffled, once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import parallelism

TOKEN = 16
K = 2
SKETCH_BITS = 6
SKETCHES = 1 << SKETCH_BITS
#: Low bits of a k-mer's long that hold its place (beyond 67 million tokens places repeat).
PLACE = 26
#: Blocks into which ids are cut by quantiles at most; the bounds, a long each, are a literal in the plan.
BLOCKS = 1 << 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(-1 << PLACE)).bitwiseOR(place)


def _kmers(tokens: Column) -> Column:
    """The k-mers, a long each, sorted by hash and place; a text of fewer than K tokens has one, of all its tokens."""
    n = F.size(tokens)
    at = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))))
    return F.sort_array(F.transform(at, lambda i: _packed(F.xxhash64(*[F.get(tokens, i + j) for j in range(K)]), i.bitwiseAND(F.lit((1 << PLACE) - 1)))))


def _numbered(kmers: Column) -> Column:
    """Longs of (k-mer, occurrence), sorted: hash and place. Runs of equal k-mers are taken apart only where there are any."""

    def entry(x: Column, o: Column) -> Column:
        return _packed(F.xxhash64(F.shiftright(x, PLACE), o), x.bitwiseAND(F.lit((1 << PLACE) - 1)))

    def begins(j: Column) -> Column:
        return (j == 0) | (F.shiftright(F.get(kmers, j), PLACE) != F.shiftright(F.get(kmers, j - 1), PLACE))

    def taken(starts: Column) -> Column:
        def run(s: Column, r: Column) -> Column:
            return F.transform(F.slice(kmers, s + 1, F.coalesce(F.get(starts, r + 1), F.size(kmers)) - s), entry)

        return F.when(F.size(starts) == F.size(kmers), F.transform(kmers, lambda x: entry(x, F.lit(0)))).otherwise(F.flatten(F.transform(starts, run)))

    places = F.when(F.size(kmers) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(kmers) - 1))
    return let(F.filter(places, begins), lambda starts: F.sort_array(taken(starts)))


def _least(numbered: Column) -> Column:
    """The two least of each sketch."""
    sketch = lambda x: F.shiftright(x, 64 - SKETCH_BITS)
    return F.filter(numbered, lambda x, j: (j < 2) | (sketch(F.get(numbered, j - 2)) != sketch(x)))


def _pairs(least: Column) -> Column:
    """(b, hash) of each sketch's two least k-mers in text order; of one, if it has one."""
    sketch = lambda x: F.shiftright(x, 64 - SKETCH_BITS)
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE) - 1))
    name = lambda x: F.shiftright(x, PLACE)

    def pair(x: Column, j: Column) -> Column:
        nxt = F.get(least, j + 1)
        two = F.coalesce(sketch(nxt) == sketch(x), F.lit(False))
        h = F.when(~two, F.xxhash64(name(x))).when(place(nxt) < place(x), F.xxhash64(name(nxt), name(x))).otherwise(F.xxhash64(name(x), name(nxt)))
        first = (j == 0) | (sketch(F.get(least, j - 1)) != sketch(x))
        return F.when(first, F.struct((sketch(x) + SKETCHES // 2).cast("int").alias("b"), h.alias("t")))

    return F.filter(F.transform(least, pair), lambda p: p.isNotNull())


def sketches(text: Column) -> Column:
    """array<struct<b int, t long>>: the filled sketches of a text, ascending b. Empty texts have none; null gives null."""
    tokens = F.regexp_extract_all(text, F.lit(rf"(?s)(?<!\S)\S{{1,{TOKEN}}}(?!\S)\s*|\S\s*|\s+"), F.lit(0))
    return let(tokens, lambda t: let(_kmers(t), lambda k: let(_numbered(k), lambda m: let(_least(m), _pairs))))


def as_text(found: Column) -> Column:
    """Hexadecimal, 10 digits a filled sketch (2 of its number, 8 of its hash)."""
    return F.concat_ws("", F.transform(found, lambda p: F.concat(F.lpad(F.hex(p["b"]), 2, "0"), F.right(F.lpad(F.hex(p["t"]), 16, "0"), F.lit(8)))))


def likeness(a: Column, b: Column) -> Column:
    """Equal sketches over sketches filled in either; 1.0 for two empty fingerprints."""
    same = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(F.transform(a, lambda p: p["b"]), F.transform(b, lambda p: p["b"])))
    return F.when(either == 0, F.lit(1.0)).otherwise(same / either)


def with_next(docs: DataFrame, values: list[str]) -> DataFrame:
    """docs(doc_id, *values) with `next`, a struct of `values` of the next row by doc_id (after the last: the first).

    Ids are cut into blocks by approximate quantiles; each block's first row is also sent, marked, to the block
    before, so one shuffle deals every row together with its next one. There are as many blocks as shuffle partitions,
    up to BLOCKS. Rows of one id are one block's and follow each other in the order of their values; rows of a null id
    come first.
    """
    blocks = min(parallelism(docs.sparkSession), BLOCKS)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)] or [0.5], max(10000, 4 * blocks))).first()[0] or []
    cuts = sorted(set(cuts))
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    # The number of bounds up to an id, by halving: a step of each power of two.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    block = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(bounds, low + step - 1) <= F.col("doc_id"), low + step).otherwise(low)) if cuts else F.lit(0)
    placed = docs.withColumn("_block", block)
    firsts = sorted((r[0], r[1]) for r in placed.groupBy("_block").agg(F.min("doc_id")).collect() if r[1] is not None)
    to = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    before = F.element_at(F.create_map(*[F.lit(x) for pair in to for x in pair]), F.col("doc_id")) if to else F.lit(None).cast("int")
    copies = F.when(before.isNull(), F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("again")))).otherwise(
        F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("again")), F.struct(before.alias("b"), F.lit(1).alias("again"))))
    dealt = placed.withColumn("_to", F.explode(copies)).withColumn("_b", F.col("_to.b")).withColumn("_again", F.col("_to.again")).drop("_to", "_block")
    over = W.partitionBy("_b").orderBy("_again", "doc_id", *values)
    return dealt.withColumn("next", F.lead(F.struct(*values)).over(over)).where("_again = 0").drop("_b", "_again")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of docs(doc_id, text).

    Null texts count as empty: an empty fingerprint. The edited text is the text with its last floor(n_chars / 2)
    code points replaced by the first as many of the next row's text. Extra columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(texts.withColumn("fp", sketches(F.col("text"))), ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.withColumn("n_chars", n).withColumn("edited", F.concat(F.left("text", n - half), F.left("next.text", half)))
    edited = edited.select("doc_id", "n_chars", "edited", "fp", F.col("next.fp").alias("next_fp")).withColumn("edited_fp", sketches(F.col("edited")))
    return edited.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
