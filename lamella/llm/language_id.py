"""Language identification of words in code-switched text by a linear-chain conditional random field.

A word's emission scores sum learned weights of its affixes (up to AFFIX letters) and letter n-grams (hashed)
and a learned multiple of its lexicon log-odds; learned transitions link neighbouring words. The lexicon counts
(hashed words by language) are summed by Spark over all training documents. The weights are fitted by
gradient steps on the exact forward-backward likelihood, on sequences that switch between documents of a
bounded sample: SAMPLE rows a language, of a longer text SAMPLE_CHARS characters at a place that the id's hash
chooses. A document's language is the one with the largest mean marginal probability over its words.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import kernels as K

AFFIX = 3
BUCKETS = 1 << 15
LEXICON = 1 << 16
SAMPLE, SAMPLE_CHARS = 150, 6000
LENGTH, BATCH, EPOCHS, RATE = 48, 48, 4, 0.3


@cache
def _by_code_point() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: 2 for a letter, 1 for a mark, else 0. Of those that take two bytes: the lower case, if that takes two too."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(len(kinds)):
        kinds[c] = {"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)
    lower = np.arange(0x800)
    for c in range(0x80, 0x800):
        small = chr(c).lower()
        if len(small) == 1 and 0x80 <= ord(small) < 0x800:
            lower[c] = ord(small)
    return kinds, lower


def kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte of UTF-8: 2 if its character is a letter, 1 if it is a mark, else 0 (bytes that aren't UTF-8: any of these)."""
    table, _ = _by_code_point()
    out = table[:128][np.minimum(data, 127)]
    at = np.flatnonzero(data >= 0xC0)
    if len(at):
        lead = data[at].astype(np.int64)
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        point = lead & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            point[more] = point[more] << 6 | data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F
        kind = table[np.minimum(point, sys.maxunicode)]
        for k in range(4):
            here = (size > k) & (at + k < len(data))
            out[at[here] + k] = kind[here]
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the letters that take two bytes in UTF-8 (Latin, Greek, Cyrillic, Armenian)."""
    out = K.LOWER[data]
    at = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xDF))
    if len(at):
        point = (data[at].astype(np.int64) & 0x1F) << 6 | data[at + 1] & 0x3F
        small = _by_code_point()[1][point]
        at, small = at[small != point], small[small != point]
        out[at], out[at + 1] = 0xC0 | small >> 6, 0x80 | small & 0x3F
    return out


class Words:
    """The distinct words (runs of letters and marks) of some rows: hashes, features, and where each occurs; lettered: rows with a letter."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = lowered(data)
        kind = kinds(low)
        self.lettered = K.per_row(kind == 2, offsets) > 0
        starts, ends, self.first = K.runs(kind > 0, offsets)
        h = K.hashes(low, starts, ends)
        self.hash, at, self.word = np.unique(h, return_index=True, return_inverse=True)
        self._features(low, starts[at], ends[at])

    def _features(self, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        size = e - s
        begins, finishes, owners, kinds = [], [], [], []
        for n in range(1, AFFIX + 1):
            for kind, a, b in ((n, s, np.minimum(s + n, e)), (n + AFFIX, np.maximum(e - n, s), e)):
                begins.append(a), finishes.append(b), owners.append(np.arange(len(s))), kinds.append(np.full(len(s), kind))
        for n in (2, 3, 4):
            per = np.maximum(size - n + 1, 0)
            owner = np.repeat(np.arange(len(s)), per)
            a = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per) + s[owner]
            begins.append(a), finishes.append(a + n), owners.append(owner), kinds.append(np.full(len(a), 10 + n))
        owner = np.concatenate(owners)
        h = K.hashes(low, np.concatenate(begins), np.concatenate(finishes))
        bucket = (K.mix(h + np.concatenate(kinds).astype(np.uint64) * K.U(0x9E3779B97F4A7C15)) % K.U(BUCKETS)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        self.owner, self.bucket = owner[order], bucket[order]
        self.at = np.searchsorted(self.owner, np.arange(len(self.hash)))
        self.lexicon = (self.hash % K.U(LEXICON)).astype(np.int64)


class Model:
    """langs, weights (BUCKETS, L), lexicon log-odds (LEXICON, L), lexicon weight, transitions (L, L) as logs."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        n = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((BUCKETS, n))
        self.lexical = np.ones(1)
        self.transitions = np.zeros((n, n))

    def emissions(self, words: Words) -> np.ndarray:
        """(distinct words, L)"""
        if not len(words.hash):
            return np.zeros((0, len(self.langs)))
        return np.add.reduceat(self.weights[words.bucket], words.at, axis=0) + self.lexical * self.lexicon[words.lexicon]


def forward_backward(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (words, L) of all rows at once, and the expected transitions (L, L).

    Rows are lanes, longest first; step t handles the t-th word of every row that has one.
    """
    n, L = scores.shape
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = first[:-1][order], lengths[order]
    e = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -60, 0)) if n else scores
    A = np.exp(transitions)
    alpha, expected = np.empty((n, L)), np.zeros((L, L))
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    for t, k in enumerate(active):
        at = begin[:k] + t
        a = e[at] if t == 0 else (alpha[at - 1] @ A) * e[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    out = alpha.copy()
    beta = np.ones((len(sizes), L))
    for t in range(len(active) - 2, -1, -1):
        k = active[t + 1]
        at = begin[:k] + t
        ahead = e[at + 1] * beta[:k]
        b = ahead @ A.T
        joint = alpha[at].T @ (ahead / np.maximum((alpha[at] * b).sum(axis=1, keepdims=True), 1e-300))
        expected += joint * A
        beta[:k] = b / b.sum(axis=1, keepdims=True)
        m = alpha[at] * beta[:k]
        out[at] = m / m.sum(axis=1, keepdims=True)
    return out, expected


def fit(model: Model, texts: list[tuple[str, str]], seed: int = 5) -> Model:
    """Fits weights, lexicon weight and transitions on sequences of LENGTH words that switch between the texts."""
    L = len(model.langs)
    index = {lang: i for i, lang in enumerate(model.langs)}
    labels = np.array([index[lang] for lang, _ in texts])
    (_, data, offsets), = K.pieces(pa.array([t for _, t in texts]), limit=1 << 40)
    words = Words(data, offsets)
    spans = [(words.first[i], words.first[i + 1], labels[i]) for i in range(len(texts)) if words.first[i] < words.first[i + 1]]
    if L < 2 or not spans:
        return model
    rng = np.random.default_rng(seed)
    squares = [np.full_like(p, 1e-2) for p in (model.weights, model.lexical, model.transitions)]
    per_word = np.diff(np.append(words.at, len(words.owner)))
    for _ in range(EPOCHS):
        parts = []
        for a, b, y in spans:  # cut each text at random places, deal the parts at random
            while a < b:
                c = min(b, a + int(rng.integers(4, LENGTH)))
                parts.append((a, c, y))
                a = c
        rng.shuffle(parts)
        at = np.concatenate([np.arange(a, b) for a, b, _ in parts])
        y = np.concatenate([np.full(b - a, lab) for a, b, lab in parts]).astype(int)
        for low in range(0, len(at), LENGTH * BATCH):
            w, t = words.word[at[low : low + LENGTH * BATCH]], y[low : low + LENGTH * BATCH]
            first = np.append(np.arange(0, len(w), LENGTH), len(w))
            u, inverse = np.unique(w, return_inverse=True)
            feature = np.repeat(words.at[u] - np.cumsum(per_word[u]) + per_word[u], per_word[u]) + np.arange(per_word[u].sum())
            buckets, owner = words.bucket[feature], np.repeat(np.arange(len(u)), per_word[u])
            emission = np.add.reduceat(model.weights[buckets], np.cumsum(per_word[u]) - per_word[u], axis=0) + model.lexical * model.lexicon[words.lexicon[u]]
            p, expected = forward_backward(emission[inverse], first, model.transitions)
            g = -p
            g[np.arange(len(t)), t] += 1
            gu = np.zeros((len(u), L))
            np.add.at(gu, inverse, g)
            ub, ui = np.unique(buckets, return_inverse=True)
            gw = np.zeros((len(ub), L))
            np.add.at(gw, ui, gu[owner])
            inside = np.ones(len(t), bool)
            inside[first[1:-1] - 1] = False
            inside[-1] = False
            i = np.flatnonzero(inside)
            observed = np.zeros((L, L))
            np.add.at(observed, (t[i], t[i + 1]), 1)
            n = len(w)
            for where, grad, p_, s_ in ((ub, gw, model.weights, squares[0]), (slice(None), np.array([(gu * model.lexicon[words.lexicon[u]]).sum()]), model.lexical, squares[1]), (slice(None), observed - expected, model.transitions, squares[2])):
                grad = grad / n * BATCH - 1e-4 * p_[where]
                s_[where] += grad**2
                p_[where] += RATE * grad / np.sqrt(s_[where])
    return model


def _lexicon_counts(batches):
    """(lang, text) -> (lang, bucket, n), summed over the task."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for row, data, offsets in K.pieces(batch.column(1)):
            low = lowered(data)
            starts, ends, first = K.runs(kinds(low) > 0, offsets)
            bucket = (K.hashes(low, starts, ends) % K.U(LEXICON)).astype(np.int64)
            here = np.repeat(langs[row : row + len(offsets) - 1], np.diff(first))
            for lang in set(here.tolist()):
                held[lang] = held.get(lang, 0) + np.bincount(bucket[here == lang], minlength=LEXICON)
    for lang, n in held.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])


def train(rows: DataFrame) -> Model | None:
    """A model from rows(doc_id, text, lang) with texts and languages; None without any.

    What reaches the driver: at most LEXICON counts a language, and the sample.
    """
    sums = rows.select("lang", "text").mapInArrow(_lexicon_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    if not langs:
        return None
    counts = np.zeros((LEXICON, len(langs)))
    counts[sums["bucket"], np.searchsorted(langs, sums["lang"])] = sums["n"]
    share = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * LEXICON)
    lexicon = np.log(share / share.mean(axis=1, keepdims=True))
    lexicon[counts.sum(axis=1) == 0] = 0
    # The sample: the rows of a language with the least hashes of their id, of which a threshold leaves about twice as many.
    eligible = rows.where("text <> ''")
    order = F.xxhash64("doc_id", F.lit("sample"))
    begin = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    sizes = {r[0]: r[1] for r in eligible.groupBy("lang").count().collect()}
    below = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, -(2.0**63) + 2.0**64 * min(1.0, 2 * SAMPLE / n))])
    near = eligible.where(order.cast("double") <= F.element_at(below, F.col("lang"))).select("lang", F.substring("text", begin, SAMPLE_CHARS).alias("text"), "doc_id", order.alias("o")) if sizes else None
    found = sorted(near.collect(), key=lambda r: (r["lang"], r["o"], r["doc_id"] is None, r["doc_id"] or 0, r["text"])) if near is not None else []
    chosen, taken = [], {}
    for r in found:
        if r["lang"] in langs and taken.setdefault(r["lang"], 0) < SAMPLE:  # a language without a word is none of the model's
            taken[r["lang"]] += 1
            chosen.append((r["lang"], r["text"]))
    return fit(Model(langs, lexicon.astype(np.float32)), chosen)


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Languages and mean marginals of the texts; `und` and 0 for texts without a letter."""
    langs, scores = [], []
    for row, data, offsets in K.pieces(texts):
        words = Words(data, offsets)
        p, _ = forward_backward(model.emissions(words)[words.word], words.first, model.transitions)
        total = np.zeros((len(p) + 1, len(model.langs)))
        np.cumsum(p, axis=0, out=total[1:])
        n = np.diff(words.first)
        mean = np.diff(total[words.first], axis=0) / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        langs += [model.langs[b] if ok else "und" for b, ok in zip(best, words.lettered)]
        scores.append(np.where(words.lettered, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0))
    return langs, np.concatenate(scores) if scores else np.zeros(0)


def languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of docs(doc_id, text, lang); rows with held_out teach nothing.

    score is the mean probability of the language over the text's words. Null texts and texts without a letter get
    `und` and 0, and so do all texts if no row teaches. Rows with a null id are not held out. Repeated rows are
    predicted alike; an empty table gives no rows; extra columns are ignored.
    """
    marked = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = train(marked.where("not held_out and text is not null and lang is not null").select("doc_id", "text", "lang"))
    if model is None:
        return marked.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS + LEXICON rows of a number a language

    def run(batches):
        for batch in batches:
            langs, scores = predict(shared.value, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return marked.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_of_words(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, end, lang_pred, score) of every letter word: its place in bytes, its likeliest language and that one's marginal."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in K.pieces(batch.column(1)):
                starts, ends, first = K.runs(kinds(lowered(data)) > 0, offsets)
                words = Words(data, offsets)
                p, _ = forward_backward(shared.value.emissions(words)[words.word], words.first, shared.value.transitions)
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
                best = p.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row + owner], pa.int64()), pa.array(starts - offsets[owner]), pa.array(ends - offsets[owner]), pa.array(np.array(shared.value.langs, object)[best], pa.string()), pa.array(p[np.arange(len(p)), best])],
                    names=["doc_id", "start", "end", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, end long, lang_pred string, score double")
