"""Operators that SQL can't express against plain Python."""

import collections
import hashlib
import itertools
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lamella.llm import common, components, kernels as K, language_id, minhash, order_minhash as OM, packing, paragraphs, quality_classifier, quality_rules, queries, surrogates, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, k):
    w = WORD.findall(lowered(text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def clusters(sets, percent=80):
    """Least member of each connected group of the sets (by key) with enough Jaccard similarity."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def groups(spark):
    """Groups of near copies about the threshold, some large, and unrelated texts."""
    rng = random.Random(12)
    texts = []
    for size, edits in ((90, 14), (40, 30), (25, 8), (12, 20), (3, 2)):
        texts += variants(rng, [f"w{rng.randrange(5000)}" for _ in range(150)], size, edits)
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 80))) for _ in range(60)]
    rng.shuffle(texts)
    return dict(enumerate(texts)), spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_near_duplicates(groups):
    texts, docs = groups
    for k in (4, 5):
        want = clusters({i: shingles(t, k) for i, t in texts.items()})
        got = minhash.near_duplicates(docs, k=k).collect()
        assert {r.id: r.component_id for r in got} == want
        assert {r.id: r.n_shingles for r in got} == {i: len(shingles(t, k)) for i, t in texts.items()}


@pytest.mark.parametrize("flags", [True, False])
def test_without_broadcast_and_bitmap(groups, monkeypatch, flags):
    texts, docs = groups
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    if not flags:
        monkeypatch.setattr(common, "bitmap", lambda places: None)
    assert {r.id: r.component_id for r in minhash.near_duplicates(docs, k=4).collect()} == clusters({i: shingles(t, 4) for i, t in texts.items()})


def test_repeated_ids(spark):
    rng = random.Random(31)
    a, b = ([f"r{rng.randrange(10**6)}" for _ in range(120)] for _ in "ab")
    rows = [(5, a), (5, b), (6, [*a[:-1], "x"]), (7, [*b[:-1], "y"]), (8, ["z"]), (8, ["z"]), (None, a)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = minhash.near_duplicates(docs).collect()
    assert sorted((r.id, r.component_id, r.kept) for r in got if r.id) == [(5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (8, 8, True)]
    kept = minhash.kept_documents(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(5, min(" ".join(a), " ".join(b))), (8, "z")]


def test_strays_of_large_buckets(spark, monkeypatch):
    """Several families that share half their words fill common buckets: found by the second banding, and by blocks alone."""
    rng = random.Random(44)
    common_words = [f"c{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for _ in range(9):
        family = common_words + [f"f{rng.randrange(10**6)}" for _ in range(40)]
        texts += variants(rng, family, 30, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = clusters({i: shingles(t, 5) for i, t in enumerate(texts)})
    assert {r.id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want
    monkeypatch.setattr(minhash, "_pairs", lambda members, stars: stars.where("rep <> pivot").selectExpr("least(rep, pivot) as a", "greatest(rep, pivot) as b").distinct())
    assert {r.id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want


def test_common_shingles(spark):
    """Sizes and shared shingles of sets, whatever the batches; an empty table has none."""
    sets = {1: [1, 2, 3, 2**63 + 5], 2: [2, 3, 9], 7: [70, 71], 8: [2**63 + 5]}
    rows = [(i, np.array(s, np.uint64).tobytes()) for i, s in sets.items()]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "rep long, shingles binary").repartition(parts)
        assert sorted(map(tuple, minhash._common(df).collect())) == [(1, 4, 3), (2, 3, 2), (7, 2, 0), (8, 1, 1)]
    assert minhash._common(df.where("rep < 0")).collect() == []


def test_sets_leave_buckets_without_a_link_for_them(spark, monkeypatch):
    """Near copies just below the threshold fill large buckets, but only the two that can be linked get to the second stars."""
    rng = random.Random(45)
    same = [f"c{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join([*same, *[f"x{rng.randrange(10**6)}" for _ in range(14 if i < 2 else 16)]]) for i in range(60)]
    stars, real = [], minhash._stars
    monkeypatch.setattr(minhash, "_stars", lambda members: stars.append(real(members)) or stars[-1])
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.id: r.component_id for r in got} == clusters({i: shingles(t, 5) for i, t in enumerate(texts)}) == {i: 0 if i < 2 else i for i in range(60)}
    assert len(stars) == 2 and stars[0].select("rep").distinct().count() > 40
    assert stars[1].select("rep").distinct().count() <= 2


def test_groups_of_buckets(spark):
    """Buckets that share members become one group only where that deals fewer rows; no pair that shares a bucket is lost."""
    alike = [(b, r, r // 3) for b in range(100, 106) for r in range(12)]  # six buckets of the same sets
    n = 2 * minhash.BLOCK
    chain = [(200 + i, 1000 * i + r, 1000 * i + r) for i in range(1, 4) for r in range(n)]
    chain += [(200 + i, 1000 * (i + 1), 1000 * (i + 1)) for i in range(1, 3)]  # a set of each bucket stands in the one before
    open_ = spark.createDataFrame(alike + chain, "bucket long, rep long, component long")
    got = minhash._grouped(open_).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.bucket, set()).add(r.rep)
        assert (r.rep, r.component) in {(x, c) for _, x, c in alike + chain}
    assert groups.pop(0) == set(range(12))
    assert groups == {b: {x for y, x, _ in chain if y == b} for b in (201, 202, 203)}
    assert len(got) == 12 + len(chain)


def test_star_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(33)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {v: find(v) for e in edges for v in e if e[0] != e[1]}
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_paragraphs(spark):
    rng = random.Random(2)
    words = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    shared = [words(60) for _ in range(6)]
    docs = []
    for i in range(80):
        lines = [" ".join(words(rng.randint(5, 90))) for _ in range(3)]
        if rng.random() < 0.6:
            lines.insert(rng.randrange(4), variants(rng, rng.choice(shared), 1, 3)[0])
        docs.append((i, "\n".join(lines)))
    sets = {}
    for i, t in docs:
        at = 0
        for line in t.split("\n"):
            n = len(WORD.findall(line))
            if 25 <= n <= paragraphs.LONG:
                sets[i, at] = shingles(line, 5)
            at += n
    root = clusters(sets)
    spans = collections.defaultdict(set)
    for k, r in root.items():
        spans[r].add(k[0])
    want = {(k, r) for k, r in root.items() if len(spans[r]) > 1}
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {((r.doc_id, r.start), (r.cluster_doc_id, r.cluster_start)) for r in got} == want
    text = {i: WORD.findall(t) for i, t in docs}
    assert all(shingles(" ".join(text[r.doc_id][r.start : r.start + r.n_words]), 5) == sets[r.doc_id, r.start] for r in got)


def test_passage_inside_long_lines(spark):
    rng = random.Random(3)
    sentence = lambda: " ".join(f"s{rng.randrange(9000)}" for _ in range(rng.randint(4, 9))).capitalize() + "."
    passage = " ".join(sentence() for _ in range(60))
    docs = [(i, " ".join(sentence() for _ in range(30)) + " " + passage + " " + " ".join(sentence() for _ in range(30))) for i in range(2)] + [(9, " ".join(sentence() for _ in range(90)))]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {0, 1}


def test_short_passages_inside_lines(spark):
    """Passages of 51 to 60 words in lines of 80 to 200 words, over line ends, twice in a document, and next to each other."""
    rng = random.Random(8)
    words = lambda n: [f"q{rng.randrange(10**6)}" for _ in range(n)]
    passages = [words(51 + i) for i in range(10)]
    docs = []
    for i, p in enumerate(passages):
        docs += [words(30) + p + words(5), words(20) + p + words(130), words(3) + p[:25] + ["\n"] + p[25:] + words(40)]
    docs += [words(9) + passages[0] + passages[1] + words(9) + passages[0], words(60) + passages[2][:49] + words(9), 2 * words(60) + words(7)]
    texts = {i: re.sub(r" ?\n ?", "\n", " ".join(d)) for i, d in enumerate(docs)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in paragraphs.repeats(df).collect():
        got[r.doc_id].append((texts[r.doc_id].split()[r.start : r.start + r.n_words], r.removed, r.cluster_doc_id, r.n_words))
    for i, p in enumerate(passages):
        assert got.pop(3 * i) == [(p, False, 3 * i, len(p))]
        for j in (1, 2):
            assert got.pop(3 * i + j) == [(p, True, 3 * i, len(p))]
    assert sorted(x[2] for x in got[30]) == [0, 0, 3] and sorted(x[0] for x in got.pop(30)) == sorted([passages[0], passages[1], passages[0]])
    assert not got
    left = {r.doc_id: r.text.split() for r in paragraphs.without_repeats(df).collect()}
    assert [len(left[i]) for i in (0, 1, 2)] == [86, 150, 43] and len(left[30]) == 18


def test_anchors_and_cuts_in_tasks_of_their_own(spark, monkeypatch):
    """No task holds the workers of both functions, however small the table of cuts is."""
    plans, real = {}, paragraphs.stored
    monkeypatch.setattr(paragraphs, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and real(df, name))
    words = [f"p{i}" for i in range(90)]
    docs = spark.createDataFrame([(i, " ".join([f"a{i}", *words, f"b{i}"])) for i in (1, 2)], "doc_id long, text string")
    removed = spark.createDataFrame([(2, 0, 30)], "doc_id long, start long, n_words long")
    got = paragraphs.repeated_passages(docs, removed).collect()
    assert sorted((r.doc_id, r.start, r.n_words, r.cluster_doc_id, r.cluster_start, r.removed) for r in got) == [(1, 30, 61, 1, 30, False), (2, 30, 61, 1, 30, True)]
    above, below = plans["live"].split("Join", 1)
    assert above.count("MapInArrow") == below.count("MapInArrow") == 1 and "Exchange hashpartitioning" in below.split("MapInArrow")[0]


@pytest.mark.parametrize("words, wrap", [(0, 0), (95, 0), (300, 0), (300, 12)])
def test_planted_passages(spark, words, wrap):
    """60 passages of 51 to 80 words, each in two documents: on a line of their own, inside lines, wrapped."""
    rng = random.Random(words + wrap)
    sentence = lambda n: " ".join(f"p{rng.randrange(20000)}" for _ in range(n))
    docs = []
    for i in range(60):
        passage = sentence(51 + i % 30)
        for _ in range(2):
            before = rng.randint(0, words)
            text = " ".join([sentence(before), passage, sentence(words - before)]).strip()
            if wrap:
                w = text.split()
                text = "\n".join(" ".join(w[j : j + wrap]) for j in range(0, len(w), wrap))
            docs.append((len(docs), sentence(40) + "\n" + text + "\n" + sentence(40)))
    got = {r.doc_id for r in paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == 120


def test_passages_equal_brute_force(spark):
    """Every run of 51 words that two documents share is in a span, and nothing else is."""
    rng = random.Random(21)
    base = [[f"b{rng.randrange(3000)}" for _ in range(300)] for _ in range(3)]
    docs = []
    for i in range(40):
        w = []
        for _ in range(rng.randint(1, 4)):
            b, a = rng.choice(base), rng.randrange(250)
            w += b[a : a + rng.randint(20, 120)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))]
        docs.append((i, " ".join(w)))
    docs.append((40, "same word " * 200))
    docs.append((41, "same word " * 150))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    holders = collections.defaultdict(set)
    for i, t in docs:
        w = t.split()
        for j in range(len(w) - 50):
            holders[tuple(w[j : j + 51])].add((i, j))
    covered = collections.defaultdict(set)
    for places in holders.values():
        if len({i for i, _ in places}) > 1:
            for i, j in places:
                covered[i] |= set(range(j, j + 51))
    got, removed = collections.defaultdict(set), collections.defaultdict(set)
    for r in paragraphs.repeated_passages(df, df.selectExpr("doc_id", "0L as start", "0L as n_words").limit(0)).collect():
        span = set(range(r.start, r.start + r.n_words))
        got[r.doc_id] |= span
        assert not (removed[r.doc_id] & span)
        if r.removed:
            removed[r.doc_id] |= span
    assert got == covered
    left = {tuple(t.split()[j : j + 51]) for i, t in docs for j in range(len(t.split()) - 50) if not set(range(j, j + 51)) & removed[i]}
    assert all(g in left for g, places in holders.items() if len({i for i, _ in places}) > 1)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def xx(*values):
    """Spark's xxhash64: each value is hashed with the hash so far as seed."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else int(v[0]).to_bytes(4, "little", signed=True) if isinstance(v, tuple) else (v % (1 << 64)).to_bytes(8, "little")
        h = xxhash.xxh64(data, seed=h).intdigest()
    return signed(h)


def order_minhash(text):
    """By the definition: k-mers with their occurrence, dealt and ranked by hash, two least of each sketch in text order."""
    space = " \t\n\x0b\f\r"
    tokens = []
    for m in re.finditer(rf"(?s)[^{space}]+[{space}]*|[{space}]+", text):
        run, tail = m[0].rstrip(space), m[0][len(m[0].rstrip(space)) :]
        tokens += [m[0]] if len(run) <= OM.TOKEN else [*run[:-1], run[-1] + tail]
    low = (1 << OM.PLACE) - 1
    seen, dealt = collections.Counter(), collections.defaultdict(list)
    for i in range(max(1, len(tokens) - OM.K + 1) if tokens else 0):
        h = xx(*tokens[i : i + OM.K]) >> OM.PLACE
        rank = xx(h, (seen[h],)) >> OM.PLACE
        seen[h] += 1
        dealt[(rank >> (64 - OM.SKETCH_BITS - OM.PLACE)) + OM.SKETCHES // 2].append((rank, i))
    out = {}
    for b, items in dealt.items():
        two = sorted(sorted(items)[:2], key=lambda t: t[1])
        out[b] = xx(*[r for r, _ in two])
    return sorted(out.items())


def overlap(a, b):
    a, b = order_minhash(a), order_minhash(b)
    either = {x for x, _ in a} | {x for x, _ in b}
    return len(set(a) & set(b)) / len(either) if either else 1.0


def test_order_minhash(spark):
    rng = random.Random(1)
    texts = ["", "a", "tail  ", "same same same same same " * 300, " ".join(f"é{rng.randrange(300)}" for _ in range(2500)), "x" * 100, "你好吗" * 40 + " end", "w" * 16 + " " + "v" * 17, *(" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 400))) for _ in range(12))]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", OM.sketches(F.col("text")).alias("s")).collect()
    for r in got:
        assert [(p.b, p.t) for p in r.s] == order_minhash(r.text)


def test_insertions_move_little(spark):
    rng = random.Random(17)
    cjk = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2000))
    word = "same " * 3000
    tails = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(300)) for _ in range(2)]
    for a, b, least in ((cjk, "x" + cjk, 0.9), (cjk, cjk[:1000] + "字" + cjk[1000:], 0.9), (word + tails[0], word + tails[1], 0.6)):
        near = spark.createDataFrame([(a, b)], "a string, b string").select(OM.likeness(OM.sketches(F.col("a")), OM.sketches(F.col("b")))).first()[0]
        assert near >= least and near == pytest.approx(overlap(a, b))


def test_whole_fingerprint_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in order_minhash_query(spark, data)}
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        r = got.pop(i)
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == (pytest.approx(overlap(a, edited)), pytest.approx(overlap(a, b)))
    assert not got


def order_minhash_query(spark, data):
    return queries.op3_order_minhash(spark, data).collect()


def test_next_row_over_blocks(spark):
    rows = [(rng, f"t{rng}") for rng in random.Random(4).sample(range(-500, 5000), 300)]
    got = OM.with_next(spark.createDataFrame(rows, "doc_id long, text string"), ["text"]).collect()
    order = sorted(rows)
    want = {a: b for (a, _), (_, b) in zip(order, order[1:] + order[:1])}
    assert {r.doc_id: r.next.text for r in got} == want


def test_order_changes_the_fingerprint_more_than_a_set(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    blocks = [words[i : i + 20] for i in range(0, 600, 20)]
    rng.shuffle(blocks)
    a, b = " ".join(words), " ".join(w for x in blocks for w in x)
    near = spark.createDataFrame([(a, b)], "a string, b string").select(OM.likeness(OM.sketches(F.col("a")), OM.sketches(F.col("b")))).first()[0]
    assert near < 0.7


def base(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_rules_base(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    for r in docs.collect():
        g, w = got[r.doc_id], base(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == w
        assert g.base_failed == (w[0] < 50 or 100 * w[4] > 50 * w[0]) and not (g.base_failed and g.kept)


def plain_kneser_ney(texts, order, least):
    """p(byte | bytes before) by the definition, over dictionaries."""
    c = [None] * (order + 1)
    raw = [collections.Counter() for _ in range(order + 1)]
    for t in texts:
        data = (255,) * (order - 1) + tuple(t.encode())
        for i in range(order, len(data) + 1):
            for n in range(1, order + 1):
                raw[n][data[i - n : i]] += 1
    c[order] = raw[order]
    for n in range(order - 1, 0, -1):
        c[n] = collections.Counter(g[1:] for g in c[n + 1])
    d = [None] * (order + 1)
    for n in range(1, order + 1):
        k = collections.Counter(c[n].values())
        y = k[1] / max(k[1] + 2 * k[2], 1)
        d[n] = [0] + [max(0, min(0.9 * i, i - (i + 1) * y * k[i + 1] / max(k[i], 1))) for i in (1, 2, 3)]
    live = [None] + [{g for g in c[n] if raw[n][g] >= least or n == 1} for n in range(1, order + 1)]
    mass = lambda n, g: c[n][g] - d[n][min(c[n][g], 3)]

    def p(g):
        if not g:
            return 1 / 256
        n = len(g)
        follow = [x for x in c[n] if x[:-1] == g[:-1]]
        if not follow:
            return p(g[1:])
        total = sum(c[n][x] for x in follow)
        gamma = 1 - sum(mass(n, x) for x in follow if x in live[n]) / total
        return (mass(n, g) / total if g in live[n] else 0.0) + gamma * p(g[1:])

    return p


def test_perplexity_equals_a_plain_model(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcd é.") for _ in range(rng.randint(1, 40))) for _ in range(12)]
    texts += texts[:3] + ["", "zq", "abab " * 12]
    docs = spark.createDataFrame([(i, t, ("x", None)[i % 2]) for i, t in enumerate(texts)] + [(99, None, "x")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.log_perplexity for r in quality_rules.perplexities(docs).collect()}
    for part in (0, 1):
        own = {i: t for i, t in enumerate(texts) if i % 2 == part}
        p = plain_kneser_ney(own.values(), quality_rules.ORDER, quality_rules.MIN_COUNT)
        for i, t in own.items():
            data = (255,) * (quality_rules.ORDER - 1) + tuple(t.encode())
            n = len(t.encode())
            logs = [np.log(p(data[j : j + quality_rules.ORDER])) for j in range(n)]
            assert got[i] == (pytest.approx(-sum(logs) / n, abs=1e-4) if n else None)
    assert got[99] is None


def test_many_shards(spark, monkeypatch):
    """Shards of 50 grams, of which two are held, and chunks of 2 kB give what one shard gives."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).repartition(3)
    want = {r.doc_id: r.log_perplexity for r in quality_rules.perplexities(docs).collect()}
    for name, value in (("SHARD", 50), ("CACHE", 2), ("CHUNK", 2000)):
        monkeypatch.setattr(quality_rules, name, value)
    got = {r.doc_id: r.log_perplexity for r in quality_rules.perplexities(docs).collect()}
    assert got.keys() == want.keys() and all(got[i] == (None if v is None else pytest.approx(v, rel=1e-9)) for i, v in want.items())


def test_scoring_holds_little():
    """A worker that scores long batches holds arrays of a piece of them: under 256 MB whatever the batch."""
    import tracemalloc
    from types import SimpleNamespace

    rng = np.random.default_rng(3)
    texts = ["".join(x) for x in rng.choice(list("abcdefgh ,."), (3000, 3000))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), pa.array(["+en"] * 3000), pa.array(texts)], names=["doc_id", "lang", "text"])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in quality_rules._rules(SimpleNamespace(value=("/none", {})))(iter([batch])))
        assert rows == 3000 and tracemalloc.get_traced_memory()[1] < 256 << 20
    finally:
        tracemalloc.stop()


def test_bands_reject_gibberish_and_keep_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    odd = [(10**6 + i, " ".join("".join(rng.choice("qxzjkvwbpf") for _ in range(rng.randint(2, 9))) for _ in range(200)), "en") for i in range(20)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs.unionByName(spark.createDataFrame(odd, docs.schema))).collect()}
    assert not any(got[i].kept for i, _, _ in odd) and not any(got[i].base_failed for i, _, _ in odd)
    good = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()]
    passed = [i for i in good if not got[i].base_failed]
    assert sum(got[i].kept for i in passed) >= 0.93 * len(passed)


def test_isotonic():
    rng = np.random.default_rng(1)
    y = np.sort(rng.random(30)) + rng.normal(size=30) * 0.2
    w = rng.integers(1, 9, 30).astype(float)
    _, fit = quality_classifier.isotonic(np.arange(30), w, y)
    assert (np.diff(fit) >= -1e-12).all()
    want = [max(min((w[a : b + 1] @ y[a : b + 1]) / w[a : b + 1].sum() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
    assert np.allclose(fit, want)


def test_statistics_by_plain_python():
    import pyarrow as pa

    rng = random.Random(8)
    texts = ["", "A b, c.\nA b, c.\n\n#x! 12?", "é ü…|", *(" ".join(rng.choice(["Ab", "cde", "1,2.", "\n", "f|g!", "hij"]) for _ in range(60)) for _ in range(4))]
    (_, data, offsets), = K.pieces(pa.array(texts))
    for text, got in zip(texts, quality_classifier.statistics(data, offsets)):
        w, n_symbols, dup, rep = WORD.findall(text), base(text)[2], base(text)[3], base(text)[4]
        size, count = [len(x.encode()) for x in w], max(len(w), 1)
        chars, lines = max(sum(map(len, w)), 1), sum(bool(WORD.search(x)) for x in text.split("\n"))
        raw = text.encode()
        share = lambda f: sum(map(f, raw))
        mean = sum(size) / count
        want = [
            np.log1p(len(w)), np.log1p(lines), sum(map(len, w)) / count, np.sqrt(max(sum(x * x for x in size) / count - mean**2, 0)), np.log1p(max(size, default=0)), n_symbols / chars, dup / max(lines, 1), rep / count,
            len({lowered(x) for x in w}) / count, share(lambda c: 65 <= c <= 90) / chars, share(lambda c: 97 <= c <= 122) / chars, share(lambda c: 48 <= c <= 57) / chars, share(lambda c: c >= 0xC0) / chars, share(lambda c: c == 46) / count,
            share(lambda c: c in b",;:") / count, share(lambda c: c in b"!?") / count, share(lambda c: c == 124) / count, sum(x <= 3 for x in size) / count,
        ]
        assert np.allclose(got, want)


def test_scores_equal_one_dense_solve(spark, data, monkeypatch):
    """The whole query on the smallest tables against one matrix of all rows; sums in several rounds."""
    import pyarrow as pa

    monkeypatch.setattr(quality_classifier, "GATHER", 2)
    QC = quality_classifier
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    got = {r.doc_id: r.score for r in QC.quality_scores(docs.repartition(9), labels).collect()}
    folds = {r.doc_id: r.f for r in docs.select("doc_id", QC.fold(5).alias("f")).collect()}
    ids, texts = zip(*[(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    x = np.concatenate([QC.statistics(d, o) for _, d, o in K.pieces(pa.array(texts))]).astype(np.float32).astype(float)
    x = dict(zip(ids, x))
    y = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and folds[r.doc_id] != 0}
    every = np.array([x[i] for i in y])
    phi = QC.Map(every.mean(axis=0), np.sqrt(np.maximum((every**2).mean(axis=0) - every.mean(axis=0) ** 2, 0)) + 1e-6)
    fit = [i for i in y if folds[i] != 4]
    z = phi(np.array([x[i] for i in fit]))
    beta = np.linalg.solve(z.T @ z + QC.RIDGE * len(fit) / QC.FEATURES * np.eye(z.shape[1]), z.T @ np.array([y[i] for i in fit], float))
    place = lambda i: int(np.clip(np.floor((phi(x[i][None]) @ beta + 0.5) / 2 * QC.BINS), 0, QC.BINS - 1)[0])
    held = collections.defaultdict(list)
    for i in y:
        if folds[i] == 4:
            held[place(i)].append(y[i])
    grid = sorted(held)
    _, fitted = QC.isotonic(np.array(grid), np.array([len(held[b]) for b in grid], float), np.array([np.mean(held[b]) for b in grid]))
    want = {i: np.interp(place(i), grid, fitted) for i in ids}
    assert sum(abs(got[i] - want[i]) < 1e-6 for i in ids) >= 0.99 * len(ids)  # a score on a bin's edge may fall either way


def test_quality_on_held_out_rows(spark):
    got = quality_classifier.quality_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    both = got.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    assert both.where("predicted = quality").count() >= 0.95 * both.count()


def test_languages_on_held_out_rows(spark):
    got = queries.op2_crf_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(3)
    scores, transitions = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 4, 4, 5, 9])
    p, expected = language_id.forward_backward(scores, first, transitions)
    want, total = np.zeros((9, 3)), np.zeros((3, 3))
    for a, b in zip(first, first[1:]):
        weights = {}
        for path in itertools.product(range(3), repeat=b - a):
            weights[path] = np.exp(sum(scores[a + i, y] for i, y in enumerate(path)) + sum(transitions[x, y] for x, y in zip(path, path[1:])))
        z = sum(weights.values())
        for path, w in weights.items() if b > a else ():
            for i, y in enumerate(path):
                want[a + i, y] += w / z
            for x, y in zip(path, path[1:]):
                total[x, y] += w / z
    assert np.allclose(p, want) and np.allclose(expected, total)


def _plain_prediction(model, text):
    """(language, score, words) by loops over characters, features and neighbours."""
    low = "".join(c.lower() if c < "\x80" or len(c.encode()) == len(c.lower().encode()) == 2 and len(c.lower()) == 1 else c for c in text or "")
    words = ["".join(g) for ok, g in itertools.groupby(low, lambda c: unicodedata.category(c)[0] in "LM") if ok]
    if not any(unicodedata.category(c)[0] == "L" for c in low):
        return "und", 0.0, words
    one = lambda b: int(K.hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0])
    scores = []
    for w in (x.encode() for x in words):
        features = [(n, w[:n]) for n in (1, 2, 3)] + [(n + 3, w[-n:]) for n in (1, 2, 3)] + [(10 + n, w[i : i + n]) for n in (2, 3, 4) for i in range(len(w) - n + 1)]
        hashed = [int(K.mix(np.array([(one(f) + kind * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0]) % language_id.BUCKETS for kind, f in features]
        scores.append(sum(model.weights[b] for b in hashed) + model.lexical[0] * model.lexicon[one(w) % language_id.LEXICON])
    n, langs = len(words), range(len(model.langs))
    e, A = np.exp(np.array(scores)), np.exp(model.transitions)
    ahead, back = [e[0]], [np.ones(len(langs))]
    for t in range(1, n):
        ahead.append(np.array([e[t, y] * sum(ahead[-1][x] * A[x, y] for x in langs) for y in langs]))
    for t in range(n - 1, 0, -1):
        back.append(np.array([sum(A[x, y] * e[t, y] * back[-1][y] for y in langs) for x in langs]))
    p = np.array([a * b / (a * b).sum() for a, b in zip(ahead, back[::-1])]).mean(axis=0)
    return model.langs[int(p.argmax())], float(p.max()), words


def test_language_prediction_by_plain_python():
    rng = np.random.default_rng(8)
    model = language_id.Model(["a", "b", "c"], rng.normal(size=(language_id.LEXICON, 3)))
    model.weights, model.transitions = rng.normal(size=(language_id.BUCKETS, 3)) / 4, rng.normal(size=(3, 3))
    texts = ["Straße — ÄÖÜ café", "Привет, мир! ЁЛКА", "ΑΘΗΝΑ Άλφα", "नमस्ते दुनिया", "——— 123 🙂", "", None, "日本語。テスト", "it’s ‘quoted’ naïve…now", "\u0301", "a", "𝒜𝒷 x", "1 2 3", "Σ" * 40 + " End"]
    langs, scores = language_id.predict(model, pa.array(texts))
    want = [_plain_prediction(model, t) for t in texts]
    assert langs == [w[0] for w in want] and np.allclose(scores, [w[1] for w in want])
    assert [langs[i] for i in (4, 5, 6, 9, 12)] == ["und"] * 5
    for text, (_, _, words) in zip(texts, want):
        (_, data, offsets), *_ = [*K.pieces(pa.array([text]))]
        low = language_id.lowered(data)
        starts, ends, _ = K.runs(language_id.kinds(low) > 0, offsets)
        assert [low[a:b].tobytes().decode() for a, b in zip(starts, ends)] == words


def test_language_with_long_texts_only(spark):
    """Texts beyond the sample's characters teach the weights too, by a slice."""
    long = [(1, "the and of with were from this " * 1000, "en"), (2, "der und die nicht sich auch eine " * 1000, "de"), (None, "der und die nicht " * 9, "de")]
    rows = spark.createDataFrame(long, "doc_id long, text string, lang string")
    model = language_id.train(rows)
    assert model.langs == ["de", "en"] and np.abs(model.weights).max() > 0
    assert language_id.predict(model, pa.array(["the and of", "nicht sich auch"]))[0] == ["en", "de"]


def test_code_switched_words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null and lang is not null")
    model = language_id.train(rows.select("doc_id", "text", "lang"))
    assert np.all(np.diag(model.transitions)[:, None] >= model.transitions)
    docs = spark.createDataFrame([(1, "the and of this that with were from und der die nicht sich auch eine mit")], "doc_id long, text string")
    got = [r.lang_pred for r in language_id.language_of_words(docs, model).orderBy("start").collect()]
    assert got[0] == "en" and got[-1] == "de" and sum(a != b for a, b in zip(got, got[1:])) <= 3


def test_tokens_equal_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("", " a  b\n\n c", "don't   stop…", "你好 мир 123 4567", "x <|endoftext|> y", "\x00\t tab\r\n", "a" * 3000, "'s 's 'S  !!??"):
        assert packing.token_ids(text, "byte_bpe_50k").tolist() == [*tok.encode(text, add_special_tokens=False).ids, 2]


def test_tokens_of_all_documents_and_random_unicode():
    """The rank file gives what the named tokenizer file gives on every text of the tables and on 500 random ones."""
    import public_tokenizers
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    rng = random.Random(12)
    ranges = ((0, 0x80), (0x80, 0x250), (0x370, 0x600), (0x900, 0xE80), (0x2000, 0x2C00), (0x3000, 0xD7FF), (0xE000, 0x10000), (0x1F300, 0x1FAFF), (0x10000, 0x10FFFF))
    odd = ["".join(chr(rng.randrange(*rng.choice(ranges))) if rng.random() < 0.7 else rng.choice(" \n\t'sS12") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t] + odd
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, found in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert packing.token_ids(text, "byte_bpe_50k").tolist() == [*found.ids, 2]


def test_whole_packing_query(spark, data):
    """start, length, ids_crc32 and places of every piece by the named tokenizer file."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    got = collections.defaultdict(list)
    fill = collections.Counter()
    rows = queries.op6_best_fit_packing(spark, data).collect()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert fill[r.sequence_id] == r.offset
        fill[r.sequence_id] += r.length
        got[r.doc_id].append(r)
    assert max(fill.values()) <= 1024 and len(fill) <= -(-sum(fill.values()) // 1024) + 1
    for d in docs:
        ids = np.array([*tok.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(got.pop(d.doc_id), key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(ids) and (len(pieces) == 1 or all(r.length == 1024 for r in pieces[1:]))
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.start == sum(x.length for x in pieces[: r.piece])
    assert not got


def test_stage_emits_what_the_mix_takes(spark):
    from lamella.llm import mixing

    rng = random.Random(2)
    rows = [(rng.choice([None, *range(12)]), " ".join("w" * rng.randint(1, 9)), rng.choice("abc")) for _ in range(60)]
    rows += rows[:6]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, out = collections.Counter(), collections.Counter()
    for r in mixing.mixed(docs).collect():
        taken[r.doc_id, r.source] += r.taken
    for r in mixing.mixed_documents(docs).collect():
        out[r.doc_id, r.source] += len(r.text.split())
    assert +taken == +out


def test_local_search_raises_squared_fill():
    rng = random.Random(7)
    for _ in range(40):
        sizes = np.array([rng.randint(1, 90) for _ in range(40)])
        bins = []
        for i in range(40):  # a poor start
            b = next((b for b in bins if sum(sizes[b]) + sizes[i] <= 100 and rng.random() < 0.5), None)
            b.append(i) if b is not None else bins.append([i])
        before = sum(sum(sizes[b]) ** 2 for b in bins)
        after = packing.local_search([list(b) for b in bins], sizes, 100)
        assert sorted(i for b in after for i in b) == list(range(40)) and max(sum(sizes[b]) for b in after) <= 100
        assert sum(sum(sizes[b]) ** 2 for b in after) >= before and len(after) <= len(bins)


def test_best_fit_fills():
    sizes = np.array([60, 50, 50, 40, 30, 30, 30, 10])
    assert len(packing.best_fit(sizes, 100)) == 3


def test_loser_tree_merge():
    rng = random.Random(11)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted((f"u{rng.randrange(9)}", f"{rng.randrange(5)}", rng.randrange(50), "", 0, "", None, f"a{i}", j, 1) for j in range(rng.randrange(12))) for i in range(k)]
        got = list(warc.merged([iter(sorted(r, key=warc._key)) for r in runs]))
        assert [warc._key(e) for e in got] == sorted(warc._key(e) for r in runs for e in r)


def test_more_runs_than_one_merge_takes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FAN", 3)
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://h', id % 7, '.example/', id % 50) as url", "repeat(cast(id % 20 as string), 900) as html").repartition(11)
    got = warc.round_trip(pages).collect()
    assert sorted(r.page_id for r in got) == list(range(400))
    keys = [(r.url_key, r.timestamp, r.page_id) for r in got]
    assert keys == sorted(keys)


def test_surrogates_are_consistent_distinct_and_alike(spark):
    texts = [f"mail user{i % 40}@mail{i % 3}.example.com card {4000000000000000 + i % 25} ip 10.0.{i % 9}.{i % 7} call +1 (555) 010-{1000 + i % 30}" for i in range(300)]
    got = surrogates.anonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    shape = re.compile(r"mail (\S+@\S+) card (\d{16}) ip (\d+\.\d+\.\d+\.\d+) call (\+1 \(\d{3}\) \d{3}-\d{4})")
    for part in range(1, 5):
        pairs = {(shape.fullmatch(texts[r.doc_id])[part], shape.fullmatch(r.text)[part]) for r in got}
        assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
        assert not {a for a, _ in pairs} & {b for _, b in pairs}
    assert {r.n_entities for r in got} == {4}


@pytest.mark.parametrize("literal", [1000, 0])
def test_collisions_are_resolved(spark, monkeypatch, literal):
    """One-digit octets: 9 values for 9 entities, and none may be one of them: more attempts are needed than one."""
    monkeypatch.setattr(surrogates, "LITERAL_ROWS", literal)
    rows = [(i, f"host 1.2.{i}.4 end") for i in range(9)]
    got = surrogates.anonymised(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.text for r in got}) == 9 and not {r.text for r in got} & {t for _, t in rows}


def test_full_formats_are_separated_or_refused(spark, monkeypatch):
    """All addresses of one letter and a domain of one: each surrogate of the same length is another's real one."""
    monkeypatch.setattr(surrogates, "ATTEMPTS", 2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]
    docs = spark.createDataFrame([(i, f"to {m} now") for i, m in enumerate(mails)], "doc_id long, text string")
    got = [r.text.split()[1] for r in surrogates.anonymised(docs).collect()]
    assert len(set(got)) == len(mails) and not set(got) & set(mails) and all(re.fullmatch(r"[a-z]+@[a-z]\.co", m) for m in got)
    monkeypatch.setattr(surrogates, "ROUNDS", 1)
    with pytest.raises(ValueError):
        surrogates.anonymised(docs).collect()


def test_luhn_and_titles(spark):
    rows = [(1, "Mr. John Smith paid with 4111 1111 1111 1111."), (2, "MRS. X. Frau Müller, Mr. JOHN SMITH"), (5, "Mr. Smith"), (3, "password=abc123DEF token: \"0123456789abcdef\""), (4, "The secret: nothing but patience. Her token = kindness; version 4.0. of 12 parts.")]
    got = {r.doc_id: r.text for r in surrogates.anonymised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    digits = [int(c) for c in re.search(r"\d{4} \d{4} \d{4} \d{4}", got[1])[0] if c != " "]
    assert sum(d if i % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits)) % 10 == 0
    name = re.match(r"Mr\. (\S+ \S+) paid", got[1])[1]
    assert name.split()[0] in surrogates.MALE and name.upper() in got[2] and "Müller" not in got[2]
    assert got[4] == dict(rows)[4] and got[5] == "Mr. " + name.split()[1]
    assert re.fullmatch(r'password=[a-z]{3}\d{3}[A-Z]{3} token: "[0-9a-f]{16}"', got[3])


def test_untitled_mentions_and_scripts(spark):
    rows = [
        (1, "Mr John Smith came. Later Smith said so; John Smith agreed, Smithson and John not."),
        (2, "Mr Алёша Попов и Попов. Mrs Άγγελος Mr Անահիտ"),
        (3, 'password: hunterhunter\n the password: required. {"pwd": "correcthorse"} at 2001:db8::ff00:42:8329, 10:30:45, call 0151 23456789'),
    ]
    got = {r.doc_id: r.text for r in surrogates.anonymised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. Later (\w+) said so; (\w+ \w+) agreed, Smithson and John not\.", got[1])
    assert m and m[2] == m[3] != "Smith" and m[4] == f"{m[1]} {m[2]}" and m[1] in surrogates.MALE
    m = re.fullmatch(r"Mr ([А-Я][а-я]{4}) ([А-Я][а-я]{4}) и ([А-Я][а-я]{4})\. Mrs ([Α-Ρ][α-ρ]{6}) Mr ([Ա-Ֆ][ա-ֆ]{5})", got[2])
    assert m and m[2] == m[3] != "Попов" and m[1] != "Алёша"
    m = re.fullmatch(r'password: ([a-z]{12})\n the password: required\. \{"pwd": "([a-z]{12})"\} at (\d{4}:[0-9a-f]{3}::[0-9a-f]{4}:\d\d:\d{4}), 10:30:45, call (0\d{3} \d{8})', got[3])
    assert m and m[1] != "hunterhunter" and m[2] != "correcthorse" and m[3] != "2001:db8::ff00:42:8329" and m[4] != "0151 23456789"


def test_kernel_words():
    texts = ["", "  a b\tc ", "é è\x0bü", "A\nB"]
    import pyarrow as pa

    for _, d, o in K.pieces(pa.array(texts), limit=4):
        starts, ends, first, _ = K.words(d, o)
        assert [bytes(d[a:b]).decode() for a, b in zip(starts, ends)] == [w for t in [bytes(d[a:b]).decode() for a, b in zip(o, o[1:])] for w in WORD.findall(t)]
