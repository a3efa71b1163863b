"""Queries of the graph library, on the sparse pair graph, generated graphs and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from .registry import PAIRS, pairgraph, query

E2 = f"{PAIRS}, e AS (SELECT src, dst, w FROM pairgraph UNION SELECT dst, src, w FROM pairgraph)"


def both(spark, d):
    return G.undirected(pairgraph(spark, d))


def first_node(edges):
    return edges.agg(F.min("src").alias("v"))


BFS = f"RECURSIVE {E2}, s AS (SELECT min(src) AS v FROM e), r(v, d) AS (SELECT v, 0 FROM s UNION SELECT e.dst, r.d + 1 FROM r JOIN e ON e.src = r.v WHERE r.d < 60), b AS (SELECT v, min(d) AS d FROM r GROUP BY v)"


@query(f"WITH {BFS} SELECT b.v, b.d::INT AS d, min(e.src) AS pred FROM b LEFT JOIN e ON e.dst = b.v AND e.src IN (SELECT v FROM b p WHERE p.d = b.d - 1) GROUP BY ALL")
def b1_bfs(spark, d):
    e = both(spark, d)
    return G.bfs(e, first_node(e))


@query()
def b2_dfs(spark, d):
    e = both(spark, d)
    start = first_node(e).first()[0]
    return G.depth_first(e, start) if start is not None else spark.createDataFrame([], "v long, d long, discover long, finish long, pred long")


@query()
def b3_astar(spark, d):
    return G.astar(G.undirected(G.grid(spark, 12, 15)), 0, 179, lambda v: abs(179 // 15 - v // 15) + abs(179 % 15 - v % 15))


PATHS = f"RECURSIVE {E2}, s AS (SELECT min(src) AS v FROM e), r(v, dist) AS (SELECT v, 0.0::DOUBLE FROM s UNION SELECT e.dst, r.dist + e.w FROM r JOIN e ON e.src = r.v WHERE r.dist < 60)"


@query(f"WITH {PATHS} SELECT s.v AS s, r.v, min(r.dist) AS dist FROM r, s GROUP BY ALL")
def b6_shortest_paths(spark, d):
    """One relaxation loop serves the dispatcher, non-negative, negative and acyclic weights."""
    e = both(spark, d)
    return G.shortest_paths(e, first_node(e))


DAG = "d(src, dst, w) AS (VALUES (1, 2, -2.0), (1, 3, 4.0), (2, 3, 1.0), (2, 4, 7.0), (3, 4, -3.0), (4, 5, 2.0))"


def dag(spark):
    return spark.createDataFrame([(1, 2, -2.0), (1, 3, 4.0), (2, 3, 1.0), (2, 4, 7.0), (3, 4, -3.0), (4, 5, 2.0)], "src long, dst long, w double")


@query(f"WITH RECURSIVE {DAG}, r(v, dist) AS (SELECT 1, 0.0::DOUBLE UNION ALL SELECT d.dst, r.dist + d.w FROM r JOIN d ON d.src = r.v) SELECT 1::BIGINT AS s, v::BIGINT AS v, min(dist) AS dist FROM r GROUP BY v")
def b7_negative_weights(spark, d):
    return G.shortest_paths(dag(spark), spark.createDataFrame([(1,)], "v long"))


@query("""WITH RECURSIVE g AS (SELECT r * 5 + c AS v, r, c FROM range(4) a(r), range(5) b(c)), e AS (SELECT a.v AS src, b.v AS dst FROM g a JOIN g b ON abs(a.r - b.r) + abs(a.c - b.c) = 1) SELECT a.v AS s, b.v AS v, (abs(a.r - b.r) + abs(a.c - b.c))::DOUBLE AS dist FROM g a, g b""")
def b9_all_pairs(spark, d):
    """All sources relax together; a grid's distances are known."""
    return G.all_pairs(G.undirected(G.grid(spark, 4, 5)))


@query()
def b11_spanning_forest(spark, d):
    return G.spanning_forest(pairgraph(spark, d))


@query(f"WITH RECURSIVE {E2}, r(v, t) AS (SELECT src, dst FROM e UNION SELECT r.v, e.dst FROM r JOIN e ON e.src = r.t) SELECT v, least(v, min(t)) AS component FROM r GROUP BY v")
def b12_components(spark, d):
    return G.roots(pairgraph(spark, d).select((F.col("src") + 1).alias("a"), (F.col("dst") + 1).alias("b"))).select((F.col("id") - 1).alias("v"), (F.col("root") - 1).alias("component"))


STRONG = "e(src, dst) AS (VALUES (1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 4), (7, 6))"


@query(f"WITH RECURSIVE {STRONG}, n AS (SELECT src AS v FROM e UNION SELECT dst FROM e), r(v, t) AS (SELECT v, v FROM n UNION SELECT r.v, e.dst FROM r JOIN e ON e.src = r.t) SELECT a.v::BIGINT AS v, min(a.t)::BIGINT AS component FROM r a JOIN r b ON a.v = b.t AND a.t = b.v GROUP BY a.v")
def b12_strong_components(spark, d):
    return G.strong_components(spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 4, 1.0), (4, 5, 1.0), (5, 4, 1.0), (6, 4, 1.0), (7, 6, 1.0)], "src long, dst long, w double"))


@query()
def b13_biconnected(spark, d):
    return G.biconnected(pairgraph(spark, d))


@query()
def b14_max_flow(spark, d):
    e = both(spark, d)
    hub = e.groupBy("src").agg(F.sum("w").alias("w")).orderBy(F.col("w").desc(), "src").limit(2).collect()
    return G.max_flow(e, hub[0][0], hub[1][0]) if hub else spark.createDataFrame([], "src long, dst long, cap double, flow double, cut boolean")


@query()
def b15_maximal_matching(spark, d):
    return G.maximal_matching(pairgraph(spark, d))


@query()
def b15_maximum_matching(spark, d):
    return G.maximum_matching(pairgraph(spark, d))


@query("SELECT i AS v, 12.0::DOUBLE AS bc FROM range(9) t(i)")
def b16_betweenness(spark, d):
    """On a cycle of 9 every node lies within as many shortest paths."""
    return G.betweenness(G.undirected(G.cycle(spark, 9)))[0]


@query(f"""WITH {E2}, u AS (SELECT DISTINCT src, dst FROM e), k AS (SELECT src AS v, count(*) AS k FROM u GROUP BY 1), t AS (SELECT a.src AS v, count(*) AS t FROM u a JOIN u b ON b.src = a.src AND a.dst < b.dst JOIN u c ON c.src = a.dst AND c.dst = b.dst GROUP BY 1)
  SELECT k.v, CASE WHEN k > 1 THEN round(2 * coalesce(t, 0) / (k * (k - 1)), 9) ELSE 0 END::DOUBLE AS cc FROM k LEFT JOIN t USING (v)""")
def b17_clustering(spark, d):
    return G.clustering(pairgraph(spark, d)).select("v", F.round("cc", 9).alias("cc"))


@query("SELECT i AS v, 1.0::DOUBLE AS cc FROM range(8) t(i)")
def b17_clique_clustering(spark, d):
    return G.clustering(G.clique(spark, 8), weighted=True)


@query("SELECT i AS v, 3::BIGINT AS core FROM range(10) t(i)")
def b18_core_numbers(spark, d):
    """Every node of a wheel has core number 3."""
    return G.core_numbers(G.wheel(spark, 10))


@query()
def b18_sparse_cores(spark, d):
    return G.core_numbers(pairgraph(spark, d))


@query()
def b19_dominators(spark, d):
    return G.dominators(dag(spark), 1)


@query(f"WITH RECURSIVE {DAG}, n AS (SELECT src AS v FROM d UNION SELECT dst FROM d), r(v, l) AS (SELECT v, 0 FROM n UNION SELECT d.dst, r.l + 1 FROM r JOIN d ON d.src = r.v) SELECT v::BIGINT AS v, max(l)::INT AS level FROM r GROUP BY v")
def b20_topological_levels(spark, d):
    return G.topological_levels(dag(spark))


@query(f"WITH {E2} SELECT count(*) AS edges, count(DISTINCT src) AS vertices FROM e")
def b21_counts(spark, d):
    return both(spark, d).agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("src").alias("vertices"))


@query("SELECT i::INT AS step, i AS v FROM range(6) t(i)")
def b22_path_from_pred(spark, d):
    tree = G.bfs(G.undirected(G.cycle(spark, 12)), spark.createDataFrame([(0,)], "v long"))
    return spark.createDataFrame(list(enumerate(G.path_to(tree, 5))), "step int, v long")


@query("""SELECT 'cycle' AS g, i AS src, (i + 1) % 7 AS dst FROM range(7) t(i) UNION ALL SELECT 'star', 0, i FROM range(1, 7) t(i) UNION ALL SELECT 'wheel', 0, i FROM range(1, 7) t(i) UNION ALL SELECT 'wheel', i, i % 6 + 1 FROM range(1, 7) t(i)
  UNION ALL SELECT 'clique', a, b FROM range(6) x(a), range(6) y(b) WHERE a < b UNION ALL SELECT 'grid', r * 4 + c, r * 4 + c + 1 FROM range(3) x(r), range(3) y(c) UNION ALL SELECT 'grid', r * 4 + c, r * 4 + c + 4 FROM range(2) x(r), range(4) y(c)""")
def b23_generators(spark, d):
    out = None
    for name, g in (("cycle", G.cycle(spark, 7)), ("star", G.star(spark, 7)), ("wheel", G.wheel(spark, 7)), ("clique", G.clique(spark, 6)), ("grid", G.grid(spark, 3, 4))):
        g = g.select(F.lit(name).alias("g"), "src", "dst")
        out = g if out is None else out.unionByName(g)
    return out


@query()
def b23_random_graph(spark, d):
    return G.random_graph(spark, 60, 0.1, 7)


@query(f"WITH {PAIRS} SELECT src, dst, w, dense_rank() OVER (ORDER BY least(src, dst), greatest(src, dst))::INT AS e FROM pairgraph")
def b24_edge_ids(spark, d):
    return G.edge_ids(pairgraph(spark, d))


@query(f"WITH {PAIRS}, n AS (SELECT src AS v FROM pairgraph UNION SELECT dst FROM pairgraph) SELECT v, round(cos(2 * pi() * (row_number() OVER (ORDER BY v) - 1) / count(*) OVER ()), 7) AS px, round(sin(2 * pi() * (row_number() OVER (ORDER BY v) - 1) / count(*) OVER ()), 7) AS py FROM n")
def b25_circle_layout(spark, d):
    return G.circle_layout(G.nodes(pairgraph(spark, d))).select("v", F.round("px", 7).alias("px"), F.round("py", 7).alias("py"))


@query(f"WITH RECURSIVE {E2}, r(v, t) AS (SELECT src, dst FROM e UNION SELECT r.v, e.dst FROM r JOIN e ON e.src = r.t), c AS (SELECT v, least(v, min(t)) AS c FROM r GROUP BY v), l AS (SELECT DISTINCT c FROM c), n AS (SELECT c AS src, lead(c) OVER (ORDER BY c) AS dst FROM l) SELECT src, dst, w FROM pairgraph UNION ALL SELECT src, dst, 1 FROM n WHERE dst IS NOT NULL")
def b26_make_connected(spark, d):
    return G.connected(pairgraph(spark, d))


@query(f"WITH {BFS} SELECT v, (d % 2)::INT AS colour FROM b")
def b27_red_black(spark, d):
    e = both(spark, d)
    return G.bfs(e, first_node(e)).select("v", (F.col("d") % 2).alias("colour"))


@query("WITH g AS (SELECT r * 5 + c AS v, r, c FROM range(4) a(r), range(5) b(c)) SELECT (abs(a.r - b.r) + abs(a.c - b.c))::BIGINT AS d, count(*) AS n FROM g a, g b WHERE a.v <> b.v GROUP BY 1")
def a28_path_histogram(spark, d):
    return G.path_lengths(G.undirected(G.grid(spark, 4, 5)))
