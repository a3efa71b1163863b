"""Graph algorithms on edge tables (src, dst, w).

Traversals are loops of joins over a frontier, each round written to the shared folder, that end when a round
changes nothing. Algorithms that need a whole graph in sequence (depth-first orders, flows, matchings) run
per component in a task: `per_component` groups edges by component, and a component must fit a task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..session import written
from . import kernels
from .components import roots


def undirected(edges: DataFrame) -> DataFrame:
    """Each edge both ways, once, without loops; of parallel edges the least weight."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.where("src <> dst").groupBy("src", "dst").agg(F.min("w").alias("w"))


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("v")).distinct()


def bfs(edges: DataFrame, sources: DataFrame, max_rounds: int = 1000, target: int | None = None, on_level: Callable[[int, DataFrame], None] | None = None) -> DataFrame:
    """(v, d, pred) of the nodes reachable from sources(v): least number of steps, and the least predecessor.

    With a target the search ends with the round that reaches it. on_level is called with each round's number and nodes.
    """
    seen = written(sources.select("v").distinct().select("v", F.lit(0).alias("d"), F.lit(None).cast("long").alias("pred")), "bfs")
    front, links = seen, edges.select("src", "dst")
    for d in range(1, max_rounds + 1):
        step = front.join(links, front["v"] == links["src"]).groupBy(F.col("dst").alias("v")).agg(F.min("src").alias("pred"))
        front = written(step.join(seen.select("v"), "v", "left_anti").select("v", F.lit(d).alias("d"), "pred"), "bfs")
        if front.isEmpty():
            return seen
        if on_level is not None:
            on_level(d, front)
        seen = seen.unionByName(front)
        if target is not None and not front.where(F.col("v") == target).isEmpty():
            return seen
    raise RuntimeError("search did not end")


def shortest_paths(edges: DataFrame, sources: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(s, v, dist) from each source(v) to the nodes it reaches: min-plus relaxation, also for negative weights.

    A round extends only the distances that the last one lowered. A ValueError tells of a negative cycle: a distance
    that still falls after as many rounds as there are nodes.
    """
    best = written(sources.select(F.col("v").alias("s"), "v", F.lit(0.0).alias("dist")).distinct(), "paths")
    front, n = best, nodes(edges).count()
    for _ in range(min(max_rounds, n + 1)):
        step = front.join(edges, front["v"] == edges["src"]).groupBy("s", F.col("dst").alias("v")).agg(F.min(F.col("dist") + F.col("w")).alias("new"))
        joined = best.join(step, ["s", "v"], "full")
        lower = F.col("new").isNotNull() & (F.col("dist").isNull() | (F.col("new") < F.col("dist")))
        state = written(joined.select("s", "v", F.when(lower, F.col("new")).otherwise(F.col("dist")).alias("dist"), lower.alias("moved")), "paths")
        best, front = state.select("s", "v", "dist"), state.where("moved").select("s", "v", "dist")
        if front.isEmpty():
            return best
    raise ValueError("a negative cycle")


def all_pairs(edges: DataFrame) -> DataFrame:
    return shortest_paths(edges, nodes(edges))


def spanning_forest(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(src, dst, w) of a minimum spanning forest by rounds of least outgoing edges, ties by (w, src, dst), src < dst."""
    e = written(undirected(edges).where("src < dst"), "edges")
    label = written(nodes(e).select("v", F.col("v").alias("c")), "parts")
    chosen = None
    for _ in range(max_rounds):
        a = e.join(label.select(F.col("v").alias("src"), F.col("c").alias("ca")), "src").join(label.select(F.col("v").alias("dst"), F.col("c").alias("cb")), "dst").where("ca <> cb")
        out = a.select(F.explode(F.array("ca", "cb")).alias("c"), F.struct("w", "src", "dst", "ca", "cb").alias("e"))
        least = written(out.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct(), "least")
        if least.isEmpty():
            break
        chosen = least.select("src", "dst", "w") if chosen is None else chosen.unionByName(least.select("src", "dst", "w"))
        joined = roots(least.select((F.col("ca") + 1).alias("a"), (F.col("cb") + 1).alias("b"))).select((F.col("id") - 1).alias("c"), (F.col("root") - 1).alias("root"))
        label = written(label.join(joined, "c", "left").select("v", F.coalesce("root", "c").alias("c")), "parts")
    return chosen if chosen is not None else e.select("src", "dst", "w").limit(0)


def strong_components(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(v, component): least node of each strongly connected component.

    Every round colours nodes with the least node that reaches them; those that their colour's node is reached from
    form a component and leave.
    """
    left = written(edges.where("src <> dst").select("src", "dst").distinct(), "edges")
    todo = written(nodes(edges), "nodes")
    done = None
    for _ in range(max_rounds):
        colour = _spread(left, todo.select("v", F.col("v").alias("c")))
        inside = left.join(colour.select(F.col("v").alias("src"), "c"), "src").join(colour.select(F.col("v").alias("dst"), F.col("c").alias("c2")), "dst").where("c = c2")
        back = _reached(inside.select(F.col("dst").alias("src"), F.col("src").alias("dst")), colour.where("v = c").select("v"))
        found = written(colour.join(back, "v").select("v", F.col("c").alias("component")), "strong")
        done = found if done is None else done.unionByName(found)
        todo = written(todo.join(found, "v", "left_anti"), "nodes")
        if todo.isEmpty():
            return done
        keep = todo.select(F.col("v").alias("k"))
        left = written(left.join(keep, F.col("src") == F.col("k"), "left_semi").join(keep, F.col("dst") == F.col("k"), "left_semi"), "edges")
    raise RuntimeError("components did not settle")


def _spread(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(v, c): the least c that reaches v."""
    state = written(start, "colours")
    while True:
        near = edges.join(state.select(F.col("v").alias("src"), "c"), "src").groupBy(F.col("dst").alias("v")).agg(F.min("c").alias("n"))
        moved = written(state.join(near, "v", "left").select("v", F.least("c", "n").alias("new"), "c"), "colours")
        state = moved.select("v", F.col("new").alias("c"))
        if moved.where("new <> c").isEmpty():
            return state


def _reached(edges: DataFrame, start: DataFrame) -> DataFrame:
    return bfs(edges, start).select("v")


def clustering(edges: DataFrame, weighted: bool = False) -> DataFrame:
    """(v, cc): closed pairs of neighbours over all pairs (0 under two neighbours); weighted by the cube root of w * w * w.

    Triangles are found from edges towards the node of higher degree, so a hub's neighbours aren't paired.
    """
    e = written(undirected(edges), "edges")
    degree = e.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    rank = degree.select(F.col("src").alias("v"), F.struct("k", F.col("src").alias("v")).alias("r"))
    up = e.join(rank.select(F.col("v").alias("src"), F.col("r").alias("rs")), "src").join(rank.select(F.col("v").alias("dst"), F.col("r").alias("rd")), "dst").where("rs < rd").select("src", "dst", "w", "rd")
    a = up.select(F.col("src").alias("u"), F.col("dst").alias("v"), F.col("w").alias("w1"), F.col("rd").alias("rv"))
    b = up.select(F.col("src").alias("u"), F.col("dst").alias("x"), F.col("w").alias("w2"), F.col("rd").alias("rx"))
    c = up.select(F.col("src").alias("v"), F.col("dst").alias("x"), F.col("w").alias("w3"))
    worth = F.cbrt(F.col("w1") * F.col("w2") * F.col("w3")) if weighted else F.lit(1.0)
    triangles = a.join(b, "u").where("rv < rx").join(c, ["v", "x"]).select(F.explode(F.array("u", "v", "x")).alias("v"), worth.alias("t"))
    closed = triangles.groupBy("v").agg(F.sum("t").alias("t"))
    out = degree.withColumnRenamed("src", "v").join(closed, "v", "left")
    return out.select("v", F.when(F.col("k") > 1, 2 * F.coalesce("t", F.lit(0.0)) / (F.col("k") * (F.col("k") - 1))).otherwise(0.0).alias("cc"))


def core_numbers(edges: DataFrame, max_rounds: int = 10000) -> DataFrame:
    """(v, core): by repeatedly lowering each node to the h-index of its neighbours' estimates, which settles at the core number."""
    e = written(undirected(edges).select("src", "dst"), "edges")
    state = written(e.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("core")), "cores")
    for _ in range(max_rounds):
        near = e.join(state.select(F.col("v").alias("dst"), F.col("core").alias("c")), "dst").groupBy("src", "c").agg(F.count(F.lit(1)).alias("n"))
        above = near.withColumn("ge", F.sum("n").over(W.partitionBy("src").orderBy(F.col("c").desc()).rowsBetween(W.unboundedPreceding, 0)))
        h = above.groupBy(F.col("src").alias("v")).agg(F.max(F.least("c", "ge")).alias("h"))
        moved = written(state.join(h, "v").select("v", F.least("core", "h").alias("new"), "core"), "cores")
        state = moved.select("v", F.col("new").alias("core"))
        if moved.where("new <> core").isEmpty():
            return state
    raise RuntimeError("cores did not settle")


def topological_levels(edges: DataFrame, max_rounds: int = 10000) -> DataFrame | None:
    """(v, level): the round in which a node has no predecessor left; None if the graph has a cycle."""
    left = written(edges.select("src", "dst").distinct(), "edges")
    todo = written(nodes(edges), "nodes")
    done = None
    for level in range(max_rounds):
        if todo.isEmpty():
            return done
        free = written(todo.join(left.select(F.col("dst").alias("v")), "v", "left_anti").select("v", F.lit(level).alias("level")), "free")
        if free.isEmpty():
            return None
        done = free if done is None else done.unionByName(free)
        todo = written(todo.join(free, "v", "left_anti"), "nodes")
        left = written(left.join(free.select(F.col("v").alias("src")), "src", "left_anti"), "edges")
    raise RuntimeError("levels did not end")


def betweenness(edges: DataFrame, sources: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((v, bc), (src, dst, bc)): shortest paths (by steps) through each node and edge, from all sources, both ways counted.

    Levels of all sources advance together, with numbers of paths; dependencies flow back level by level.
    """
    e = written(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    start = nodes(e) if sources is None else sources
    levels = [written(start.select(F.col("v").alias("s"), "v", F.lit(1.0).alias("paths")), "level")]
    seen = levels[0].select("s", "v")
    while True:
        step = levels[-1].join(e, levels[-1]["v"] == e["src"]).groupBy("s", F.col("dst").alias("v")).agg(F.sum("paths").alias("paths"))
        nxt = written(step.join(seen, ["s", "v"], "left_anti"), "level")
        if nxt.isEmpty():
            break
        levels.append(nxt)
        seen = seen.unionByName(nxt.select("s", "v"))
    delta = levels[-1].select("s", "v", "paths", F.lit(0.0).alias("delta"))
    vertex, edge = [], []
    for k in range(len(levels) - 1, 0, -1):
        ahead = delta.select("s", F.col("v").alias("dst"), F.col("paths").alias("pd"), "delta")
        flow = levels[k - 1].withColumnRenamed("v", "src").join(e, "src").join(ahead, ["s", "dst"]).select("s", "src", "dst", "paths", (F.col("paths") / F.col("pd") * (1 + F.col("delta"))).alias("f"))
        flow = written(flow, "flow")
        edge.append(flow.select("src", "dst", "f"))
        vertex.append(delta.where("v <> s").select("v", "delta"))
        own = flow.groupBy("s", F.col("src").alias("v")).agg(F.sum("f").alias("delta"))
        delta = written(levels[k - 1].join(own, ["s", "v"], "left").select("s", "v", "paths", F.coalesce("delta", F.lit(0.0)).alias("delta")), "delta")
    by_vertex = nodes(e).select("v", F.lit(0.0).alias("delta"))
    for part in vertex:
        by_vertex = by_vertex.unionByName(part)
    by_edge = e.select("src", "dst", F.lit(0.0).alias("f"))
    for part in edge:
        by_edge = by_edge.unionByName(part)
    return by_vertex.groupBy("v").agg(F.sum("delta").alias("bc")), by_edge.groupBy("src", "dst").agg(F.sum("f").alias("bc"))


def maximal_matching(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(src, dst): rounds in which every edge that is the least, by (w descending, src, dst), at both its ends is taken."""
    left = written(undirected(edges).where("src < dst"), "edges")
    done = left.select("src", "dst").limit(0)
    for _ in range(max_rounds):
        if left.isEmpty():
            return done
        key = F.struct((-F.col("w")).alias("k"), "src", "dst")
        ends = left.select(F.explode(F.array("src", "dst")).alias("v"), key.alias("key"))
        best = ends.groupBy("v").agg(F.min("key").alias("key"))
        mutual = best.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n = 2")
        taken = written(mutual.select("key.src", "key.dst"), "taken")
        done = done.unionByName(taken)
        used = taken.select(F.explode(F.array("src", "dst")).alias("v"))
        left = written(left.join(used.select(F.col("v").alias("src")), "src", "left_anti").join(used.select(F.col("v").alias("dst")), "dst", "left_anti"), "edges")
    raise RuntimeError("matching did not end")


def per_component(edges: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """run on each component's edges (src, dst, w, both ways as given), in one task each."""
    ids = roots(edges.select((F.col("src") + 1).alias("a"), (F.col("dst") + 1).alias("b"))).select((F.col("id") - 1).alias("src"), "root")
    own = edges.join(ids, "src").select("root", "src", "dst", "w")
    return own.groupBy("root").applyInPandas(lambda pdf: run(pdf.drop(columns="root").sort_values(["src", "dst"])), schema)


def biconnected(edges: DataFrame) -> DataFrame:
    """(src, dst, part, cut): the biconnected part of each edge (by its least edge), and whether src is an articulation point."""
    return per_component(undirected(edges), kernels.biconnected, "src long, dst long, part string, cut boolean")


def depth_first(edges: DataFrame, start: int) -> DataFrame:
    """(v, d, discover, finish, pred) from start, neighbours in ascending order; the graph is searched in one task."""
    whole = edges.withColumn("root", F.lit(0))
    return whole.groupBy("root").applyInPandas(lambda pdf: kernels.depth_first(pdf, start), "v long, d long, discover long, finish long, pred long")


def max_flow(edges: DataFrame, source: int, sink: int) -> DataFrame:
    """(src, dst, cap, flow, cut): a maximum flow, and whether src lies on the source's side of a minimum cut."""
    whole = edges.withColumn("root", F.lit(0))
    return whole.groupBy("root").applyInPandas(lambda pdf: kernels.max_flow(pdf, source, sink), "src long, dst long, cap double, flow double, cut boolean")


def maximum_matching(edges: DataFrame) -> DataFrame:
    """(src, dst): a matching of the most edges, by component (Edmonds' blossoms)."""
    return per_component(undirected(edges), kernels.maximum_matching, "src long, dst long")


def dominators(edges: DataFrame, start: int) -> DataFrame:
    """(v, idom): immediate dominators of the nodes reachable from start."""
    whole = edges.withColumn("root", F.lit(0))
    return whole.groupBy("root").applyInPandas(lambda pdf: kernels.dominators(pdf, start), "v long, idom long")


def astar(edges: DataFrame, start: int, goal: int, heuristic: Callable[[int], float]) -> DataFrame:
    """(step, v, dist): a cheapest path found with a lower bound on the rest of the way."""
    whole = edges.withColumn("root", F.lit(0))
    return whole.groupBy("root").applyInPandas(lambda pdf: kernels.astar(pdf, start, goal, heuristic), "step long, v long, dist double")


def path_to(tree: DataFrame, target: int, max_rounds: int = 10000) -> list[int]:
    """The nodes from the root of a tree(v, pred) to target: the pointers are followed one lookup a step."""
    path = [target]
    for _ in range(max_rounds):
        row = tree.where(F.col("v") == path[-1]).select("pred").first()
        if row is None or row[0] is None:
            return path[::-1]
        path.append(row[0])
    raise RuntimeError("no root")


def path_lengths(edges: DataFrame) -> DataFrame:
    """(d, n): number of ordered pairs at each least number of steps."""
    steps = all_pairs(edges.withColumn("w", F.lit(1.0))).where("s <> v")
    return steps.groupBy(F.col("dist").cast("long").alias("d")).agg(F.count(F.lit(1)).alias("n"))


def connected(edges: DataFrame) -> DataFrame:
    """edges and, to join the components, edges of weight 1 between consecutive components' least nodes."""
    least = roots(edges.select((F.col("src") + 1).alias("a"), (F.col("dst") + 1).alias("b"))).select((F.col("root") - 1).alias("v")).distinct()
    chain = least.withColumn("n", F.lead("v").over(W.orderBy("v"))).where("n is not null")
    return edges.select("src", "dst", "w").unionByName(chain.select(F.col("v").alias("src"), F.col("n").alias("dst"), F.lit(1.0).alias("w")))


def edge_ids(edges: DataFrame) -> DataFrame:
    """edges with row-first numbers from 1; each way of an undirected edge has the number of the way with src < dst."""
    one = F.struct(F.least("src", "dst"), F.greatest("src", "dst"))
    return edges.withColumn("e", F.dense_rank().over(W.orderBy(one)))


def cycle(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst"), F.lit(1.0).alias("w"))


def clique(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n * n).select(F.floor(F.col("id") / n).alias("src"), (F.col("id") % n).alias("dst"), F.lit(1.0).alias("w")).where("src < dst")


def star(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("w"))


def wheel(spark: SparkSession, n: int) -> DataFrame:
    rim = spark.range(1, n).select(F.col("id").alias("src"), (F.col("id") % (n - 1) + 1).alias("dst"), F.lit(1.0).alias("w"))
    return star(spark, n).unionByName(rim)


def grid(spark: SparkSession, rows: int, columns: int) -> DataFrame:
    at = spark.range(rows * columns).select("id", (F.col("id") % columns).alias("c"), F.floor(F.col("id") / columns).alias("r"))
    step = lambda cond, d: at.where(cond).select(F.col("id").alias("src"), (F.col("id") + d).alias("dst"), F.lit(1.0).alias("w"))
    return step(f"c < {columns - 1}", 1).unionByName(step(f"r < {rows - 1}", columns))


def random_graph(spark: SparkSession, n: int, p: float, seed: int = 1) -> DataFrame:
    """Each of the pairs with probability p, by a hash of the pair: equal on every run."""
    pairs = spark.range(n * n).select(F.floor(F.col("id") / n).alias("src"), (F.col("id") % n).alias("dst")).where("src < dst")
    chance = F.pmod(F.xxhash64("src", "dst", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    return pairs.where(chance < p).withColumn("w", F.lit(1.0))


def circle_layout(vertices: DataFrame, radius: float = 1.0) -> DataFrame:
    """(v, px, py): the nodes in ascending order, evenly round a circle."""
    n = F.count(F.lit(1)).over(W.partitionBy(F.lit(0)))
    angle = 2 * 3.141592653589793 * (F.row_number().over(W.orderBy("v")) - 1) / n
    return vertices.select("v", (radius * F.cos(angle)).alias("px"), (radius * F.sin(angle)).alias("py"))
