"""Hand-checked cases and properties of the volume operators."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions import scalars as S
from lamella.operators import cleanup, components as C, evaluate, fusion, graph as G, kernels as KN, learn as L, matching as M, overlap as O, regions as R
from lamella.plans import catalogue  # noqa: F401
from lamella.plans.registry import QUERIES, dense_pairs
from lamella.schema import assert_schema


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_global_map(spark):
    merges = spark.createDataFrame([(5, 3), (3, 9), (7, 7), (2, 8), (0, 4)], "a long, b long")
    assert {r.old: r.new for r in C.global_map(merges).collect()} == {0: 0, 2: 1, 8: 1, 3: 2, 5: 2, 9: 2, 7: 3}


def test_roots_of_random_graphs_and_a_long_path(spark):
    rng = random.Random(3)
    edges = [(rng.randint(1, 300), rng.randint(1, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.root for r in C.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for e in edges for v in e}


def test_empty_merges(spark):
    assert C.global_map(spark.createDataFrame([], "a long, b long")).collect() == [(0, 0)]


def test_unknown_label_is_an_error(spark):
    labels = spark.createDataFrame([(1,), (9,)], "label long")
    with pytest.raises(Exception, match="without a place"):
        C.remapped(labels, spark.createDataFrame([(1, 1)], "old long, new long")).collect()


@pytest.mark.parametrize("ov,a1,a2,want", [(2001, 2200, 9000, True), (2000, 2000, 9000, False), (20001, 10**6, 10**6, True), (2500, 3000, 3100, True), (2500, 4000, 3100, False)])
def test_threshold_rule(spark, ov, a1, a2, want):
    assert one(spark, O.matches_theta(F.lit(ov), F.lit(a1), F.lit(a2))) is want


def test_link_worth(spark):
    assert one(spark, S.link_worth(F.lit(100), F.lit(200), F.lit(50), F.lit(2))) == pytest.approx(0.25 * 100**0.9 * 0.75)


def test_exclusion_sets(spark):
    rows = [(0, 0, 0, 1), (0, 0, 0, 2), (0, 0, 1, 2), (0, 0, 1, 1), (0, 0, 2, 3), (0, 0, 2, 0)]
    got = O.exclusion_sets(spark.createDataFrame(rows, "z int, y int, x int, label long")).collect()
    assert [(r.z, r.labels) for r in got] == [(0, [1, 2])]


def test_stable_match_small(spark):
    pairs = spark.createDataFrame([(1, 10, 10), (1, 11, 9), (2, 10, 12)], "l1 long, l2 long, ov long")
    assert {tuple(r) for r in M.stable(pairs).collect()} == {(2, 10), (1, 11)}


def test_stable_match_has_no_blocking_pair(spark, data):
    pairs = dense_pairs(spark, data)
    ov = {(r.l1, r.l2): r.ov for r in pairs.collect()}
    mate = {(r.l1, r.l2) for r in M.stable(pairs).collect()}
    his, hers = dict(mate), {b: a for a, b in mate}
    assert len(his) == len(hers) == len(mate)
    for (a, b), n in ov.items():
        better_a = a not in his or (-n, b) < (-ov[a, his[a]], his[a])
        better_b = b not in hers or (-n, a) < (-ov[hers[b], b], hers[b])
        assert not (better_a and better_b) or (a, b) in mate


def accepted(ov, k):
    """Deferred acceptance with quotas, one proposal at a time."""
    likes = {a: sorted((b for x, b in ov if x == a), key=lambda b: (-ov[a, b], b)) for a, _ in ov}
    held = {}
    again = True
    while again:
        again = False
        for a in likes:
            while likes[a] and sum(a in h for h in held.values()) < k:
                b = likes[a].pop(0)
                held.setdefault(b, []).append(a)
                held[b].sort(key=lambda x: (-ov[x, b], x))
                del held[b][k:]
                again = True
    return {(a, b) for b, h in held.items() for a in h}


@pytest.mark.parametrize("k", [1, 2, 3])
def test_matching_with_quotas(spark, k):
    rng = random.Random(k)
    ov = {(g, a, b): rng.randint(1, 9) for g in range(3) for a in range(9) for b in range(7) if rng.random() < 0.5}
    pairs = spark.createDataFrame([(g, a, b, n) for (g, a, b), n in ov.items()], "pair long, l1 long, l2 long, ov long")
    got = {tuple(r) for r in M.polygamous(pairs, k).collect()}
    assert got == {(g, a, b) for g in range(3) for a, b in accepted({(a, b): n for (h, a, b), n in ov.items() if h == g}, k)}


def test_evaluation_good_region(spark):
    rows = [(0, i, 1, 1 if i < 70 else 0) for i in range(100)] + [(0, 100 + i, 2, 1) for i in range(30)]
    df = spark.createDataFrame([(z, 0, x, a, b) for z, x, a, b in rows], "z int, y int, x int, gt_ long, seg_ long")
    got = {r.gt: r.region for r in evaluate.scored_regions(df, "gt_", "seg_").collect()}
    assert got == {1: "good", 2: "merge"}


def test_evaluation_against_the_loop(spark):
    rng = random.Random(5)
    rows = [(z, i, 0, rng.randint(0, 4), rng.randint(0, 4)) for z in range(6) for i in range(150)]
    df = spark.createDataFrame(rows, "z int, y int, x int, gt_ long, seg_ long")
    want = {}
    for z in range(6):
        own = [(a, b) for zz, _, _, a, b in rows if zz == z and a > 0]
        size = {a: sum(1 for p in own if p[0] == a) for a, _ in own}
        seg = {b: sum(1 for p in own if p[1] == b) for _, b in own if b > 0}
        claimed = set()
        for a in sorted(size):
            flags, new = set(), False
            for b, n in sorted(((b, sum(1 for p in own if p == (a, b))) for b in seg), key=lambda t: (-t[1], t[0])):
                if not n:
                    continue
                mg, ms = n / size[a] > 1 - 0.8, n / seg[b] > 1 - 0.8
                if mg and ms:
                    flags.add("good")
                    break
                if mg:
                    new |= b not in claimed
                    claimed.add(b)
                    flags.add("merge")
                else:
                    flags.add("split" if ms else "adjust")
            want[z, a] = next((f for f in ("good", "merge", "split", "adjust") if f in flags), "none")
    got = {(r.z, r.gt): r.region for r in evaluate.scored_regions(df, "gt_", "seg_", 1, 0.8).collect()}
    assert got == want


def test_agglomeration_joins_the_weakest_boundary(spark):
    stats = spark.createDataFrame([(0, a, b, n, p) for x, y, n, p in ((1, 2, 4, 2.0), (1, 3, 4, 0.4), (2, 3, 5, 1.0)) for a, b in ((x, y), (y, x)) for n, p in ((n, p),)], "block long, a long, b long, n long, psum double")
    sizes = spark.createDataFrame([(0, 1, 5), (0, 2, 200), (0, 3, 150)], "block long, label long, area long")
    assert {r.label: r.target for r in cleanup.agglomerated(stats, sizes, 100).collect()} == {1: 3, 2: 2, 3: 3}


def test_upper_median_and_labelled():
    mask = np.array([[1, 0, 1], [1, 0, 1], [0, 1, 0]], bool)
    assert KN.labelled(mask)[0].tolist() == [[1, 0, 2], [1, 0, 2], [0, 3, 0]]


def test_mask_components_equal_flood_fill(spark):
    rng = np.random.default_rng(2)
    mask = rng.random((15, 17)) < 0.55
    rows = [(0, int(y), int(x), int(y) * 17 + int(x) + 1) for y, x in zip(*np.nonzero(mask))]
    got = {(r.y, r.x): r.root for r in R.mask_components(spark.createDataFrame(rows, "z int, y int, x int, pid long")).collect()}
    flood = KN.labelled(mask)[0]
    pairs = {(flood[k], v) for k, v in got.items()}
    assert len(got) == mask.sum() and len(pairs) == flood.max() == len({b for _, b in pairs})


def test_max_flow_equals_min_cut(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 12), rng.randint(0, 12), float(rng.randint(1, 9))) for _ in range(60)]
    edges = [e for e in edges if e[0] != e[1]]
    got = G.max_flow(spark.createDataFrame(edges, "src long, dst long, w double"), 0, 12).collect()
    into = sum(r.flow for r in got if r.dst == 12) - sum(r.flow for r in got if r.src == 12)
    side = {r.src for r in got if r.cut}
    assert into == pytest.approx(sum(r.cap for r in got if r.src in side and r.dst not in side))
    for v in range(1, 12):
        assert sum(r.flow for r in got if r.src == v) == pytest.approx(sum(r.flow for r in got if r.dst == v))


def test_spanning_forest_weight(spark):
    rng = random.Random(4)
    edges = [(a, b, float(rng.randint(1, 30))) for a, b in itertools.combinations(range(14), 2) if rng.random() < 0.4]
    got = G.spanning_forest(spark.createDataFrame(edges, "src long, dst long, w double")).collect()
    parent, total = list(range(14)), 0.0

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, w in sorted(edges, key=lambda e: e[2]):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            total += w
    assert sum(r.w for r in got) == total


def test_maximum_matching_by_subsets():
    import pandas as pd

    rng = random.Random(8)
    for _ in range(30):
        pairs = [p for p in itertools.combinations(range(7), 2) if rng.random() < 0.4]
        if not pairs:
            continue
        edges = pd.DataFrame([(a, b, 1.0) for p in pairs for a, b in (p, p[::-1])], columns=["src", "dst", "w"])
        got = KN.maximum_matching(edges)
        best = max((len(s) for n in range(4) for s in itertools.combinations(pairs, n) if len({v for e in s for v in e}) == 2 * n), default=0)
        assert len(got) == best and len(set(got["src"]) | set(got["dst"])) == 2 * best


def test_biconnected_bridge(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 4, 1.0)], "src long, dst long, w double")
    got = {(r.src, r.dst): (r.part, r.cut) for r in G.biconnected(edges).collect()}
    assert got[1, 2][0] == got[2, 3][0] != got[3, 4][0] and [v for v in (1, 2, 3, 4) if any(c for (a, _), (_, c) in got.items() if a == v)] == [3]


def test_dominators(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (1, 3, 1.0), (2, 4, 1.0), (3, 4, 1.0), (4, 5, 1.0)], "src long, dst long, w double")
    assert {r.v: r.idom for r in G.dominators(edges, 1).collect()} == {1: None, 2: 1, 3: 1, 4: 1, 5: 4}


def test_negative_cycle_and_cyclic_order(spark):
    bad = spark.createDataFrame([(1, 2, 1.0), (2, 1, -2.0)], "src long, dst long, w double")
    with pytest.raises(ValueError, match="negative cycle"):
        G.shortest_paths(bad, spark.createDataFrame([(1,)], "v long"))
    assert G.topological_levels(bad) is None


def test_edge_betweenness_of_a_path(spark):
    _, edge = G.betweenness(G.undirected(spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "src long, dst long, w double")))
    assert {(r.src, r.dst): r.bc for r in edge.collect()} == {(0, 1): 2.0, (1, 0): 2.0, (1, 2): 2.0, (2, 1): 2.0}


def test_fusion_equals_all_subsets():
    rng = random.Random(6)
    for _ in range(40):
        n = 6
        worth = [rng.random() for _ in range(n)]
        sets = [{rng.randrange(n), rng.randrange(n)} for _ in range(3)]
        sets = [s for s in sets if len(s) == 2]
        links = [(a, b, rng.random()) for a in range(3) for b in range(3, 6) if rng.random() < 0.4]
        value, chosen = KN.best_selection(worth, sets, links)
        best = 0.0
        for k in range(n + 1):
            for c in itertools.combinations(range(n), k):
                if any(s <= set(c) for s in sets):
                    continue
                own = [l for l in links if l[0] in c and l[1] in c]
                total = sum(worth[i] for i in c) + max(
                    sum(w for *_, w in pick) for m in range(len(own) + 1) for pick in itertools.combinations(own, m) if len({a for a, *_ in pick}) == len({b for _, b, _ in pick}) == m
                )
                best = max(best, total)
        assert value == pytest.approx(best) and not any(s <= set(chosen) for s in sets)


def test_fusion_of_many_free_segments():
    value, chosen = KN.best_selection([1.0] * 1200, [{0, 1}], [(i, i + 1, 0.5) for i in range(2, 40)])
    assert len(chosen) == 1199 and abs(value - (1199 + 19.0)) < 1e-9 or abs(value - (1199 + 38 * 0.5)) < 1e-9


def test_fusion_respects_exclusions(spark):
    segments = spark.createDataFrame([(1, 10, 5.0), (2, 10, 4.0), (3, 10, 3.0)], "label long, area long, worth double")
    sets = spark.createDataFrame([(1, 1), (1, 2)], "set long, label long")
    links = spark.createDataFrame([(2, 3, 4.0)], "l1 long, l2 long, worth double")
    assert {r.label for r in fusion.solved(segments, sets, links).where("chosen").collect()} == {2, 3}


def test_stumps_must_find_their_feature(spark):
    long = spark.createDataFrame([(1, "a", 0.5)], "id long, feature string, v double")
    ok = spark.createDataFrame([("a", 0.4, -1.0, 2.0)], "feature string, thr double, lo double, hi double")
    assert L.stump_scores(long, ok).first().score == 2.0
    with pytest.raises(ValueError, match="no feature called b"):
        L.stump_scores(long, spark.createDataFrame([("b", 0.4, -1.0, 2.0)], ok.schema))


def test_tiles_equal_the_whole_image(spark):
    rng = np.random.default_rng(0)
    a = rng.random((20, 23))
    rows = [(z, int(y), int(x), float(a[y, x])) for z in (0, 5) for y in range(20) for x in range(23)]
    run = lambda t: t + np.roll(t, 1, 0) + np.roll(t, 1, 1)
    got = L.on_tiles(spark.createDataFrame(rows, "z int, y int, x int, v double"), 8, 1, run).collect()
    padded = np.pad(a, 1, "symmetric")
    want = run(padded)[1:-1, 1:-1]
    assert len(got) == 2 * a.size and {r.z for r in got} == {0, 5} and all(abs(r.v - want[r.y, r.x]) < 1e-12 for r in got)


def test_schema_check(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert assert_schema(df, "merges") is df
    with pytest.raises(ValueError, match="missing"):
        assert_schema(df.drop("b"), "merges")


def test_forest_predicts_in_a_session_with_observations(spark):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    samples = spark.createDataFrame([(i, [float(i), float(i % 3)], int(i >= 20)) for i in range(40)], "id long, f array<double>, cls int")
    got = {r.id: r for r in L.predicted(L.train_forest(samples, trees=4, depth=3), samples).collect()}
    assert len(got) == 40 and got[2].prediction == 0 and got[37].prediction == 1 and got[2].p < 0.5 < got[37].p


def test_saturated_pixels_at_a_decimal_bound(spark):
    # The middle of an edge has three links; 2 * (0.45 - 0.3) is the double next above 0.3, their weight.
    image = spark.createDataFrame([(0, y, x, 0.45 if (y, x) == (0, 1) else 0.3) for y in range(2) for x in range(3)], "z int, y int, x int, v double")
    assert {(r.y, r.x): r.fixed for r in R.saturated(image, 0.1, 0.3).collect()} == {(y, x): 1 if (y, x) == (0, 1) else None for y in range(2) for x in range(3)}


def test_nearest_of_all_pairs_in_blocks(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randint(0, 2) / 3 for _ in range(4)]) for i in range(300)] + [(300, [0.5, None, 0.25]), (301, [9.0]), (302, None)]
    e = spark.createDataFrame(rows, "b long, e array<float>")
    asked = e.where("b % 10 = 0").select(F.col("b").alias("a"), "e")
    found = M.nearest(asked, e.where("b % 10 <> 0"), 1.01, 8, 50)
    assert not any(word in found._jdf.queryExecution().executedPlan().toString() for word in ("NestedLoop", "Cartesian"))
    full = {r.b: r.e for r in e.where("e is not null").collect()}
    want = {}
    for a in (i for i in full if i % 10 == 0):
        near = sorted((round(sum((p - q) ** 2 for p, q in zip(full[a], v) if p is not None and q is not None), 9), b) for b, v in full.items() if b % 10)
        if 1.01 * near[0][0] < near[1][0]:
            want[a] = (near[0][1], near[0][0])
    assert {r.a: (r.b, r.dist) for r in found.collect()} == want
    two = KN.two_nearest(*[(np.zeros((n, 3)), np.ones((n, 3), bool)) for n in (2, 5)], np.array([4, 3, 9, 1, 7]))
    assert [c.tolist() for c in two] == [[0, 0, 1, 1], [1, 3, 1, 3], [0.0] * 4]


def test_flow_and_search_of_a_graph_without_edges(spark, tmp_path):
    spark.createDataFrame([(1, 5)], "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("b14_max_flow", "b2_dfs"):
        assert QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("tile", [4, 1024])
def test_mask_components_over_tiles_without_needless_rounds(spark, tile, monkeypatch):
    rng = np.random.default_rng(3)
    masks = {z: rng.random((13, 18)) < 0.6 for z in (0, 1, 4)}
    dy, dx = (5, 6) if tile == 4 else (0, 0)
    rows = [(z, int(y) - dy, int(x) - dx, 1000 * z + int(y) * 18 + int(x) + 1) for z, m in masks.items() for y, x in zip(*np.nonzero(m))]
    rounds = []
    monkeypatch.setattr(R, "roots", lambda edges: rounds.append(1) or C.roots(edges))
    found = R.mask_components(spark.createDataFrame(rows, "z int, y int, x int, pid long"), tile)
    got = {(r.z, r.y + dy, r.x + dx): r.root for r in found.collect()}
    want = {}
    for z, m in masks.items():
        flood = KN.labelled(m)[0]
        least = {}
        for y, x in zip(*np.nonzero(m)):
            least.setdefault(flood[y, x], 1000 * z + int(y) * 18 + int(x) + 1)
        want |= {(z, y, x): least[flood[y, x]] for y, x in zip(*np.nonzero(m))}
    assert got == want and len(rounds) == (tile == 4)
    holes = {r.root: r.euler for r in R.euler_numbers(found).collect()}
    for root in set(want.values()):
        own = {k for k, v in want.items() if v == root}
        near = lambda dy, dx: sum((z, y + dy, x + dx) in own for z, y, x in own)
        assert holes[root] == len(own) - near(0, 1) - near(1, 0) + sum({(z, y + 1, x), (z, y, x + 1), (z, y + 1, x + 1)} <= own for z, y, x in own)


def test_overlaps_of_lines_are_counted_once(spark, data):
    assert "l_suppkey" not in QUERIES["j11_orphan_join"](spark, data)._jdf.queryExecution().optimizedPlan().toString()


def test_fusion_reads_its_solution_and_links_from_tables(spark, data, monkeypatch):
    seen = []
    monkeypatch.setattr(fusion, "fused", lambda c, solution, links: seen.extend((solution, links)) or c)
    QUERIES["m1_fusion"](spark, data)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    assert len(plans) == 2 and not any(word in plan for plan in plans for word in ("Pandas", "Join"))
