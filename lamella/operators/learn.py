"""Pixel classification: stumps, forests as node tables, training with Spark ML, networks on tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import logistic
from . import kernels


def stump_scores(long: DataFrame, stumps: DataFrame, key: str = "id") -> DataFrame:
    """(key, score, p) of features in long form (key, feature, v); every stump must find its feature for every key.

    Stumps that no feature matches raise an error.
    """
    names = long.select("feature").distinct()
    lost = stumps.join(names, "feature", "left_anti").select("feature").limit(1).collect()
    if lost:
        raise ValueError(f"no feature called {lost[0][0]}")
    joined = long.join(F.broadcast(stumps) if stumps.limit(100001).count() <= 100000 else stumps, "feature")
    score = F.sum(F.when(F.col("v") <= F.col("thr"), F.col("lo")).otherwise(F.col("hi")))
    return joined.groupBy(key).agg(score.alias("score")).withColumn("p", logistic(F.col("score")))


def forest_votes(samples: DataFrame, forest: DataFrame, key: str = "id", depth: int = 32) -> DataFrame:
    """(key, cls, p): the share of trees that vote for each class.

    samples(key, f array<double>); forest(tree, node, status, feature, thr, left, right, cls) with ids from 1, status -1 in
    leaves. All samples walk all trees a level a round, by a join on (tree, node): the forest is a table like any other
    and is broadcast only if its count allows it.
    """
    trees = forest.select("tree").distinct().count()
    side = F.broadcast(forest) if forest.limit(1_000_001).count() <= 1_000_000 else forest
    walk = samples.join(F.broadcast(forest.select("tree").distinct())).withColumn("node", F.lit(1))
    for _ in range(depth):
        at = walk.join(side, ["tree", "node"])
        step = F.when(F.col("status") == -1, F.col("node")).when(F.element_at("f", F.col("feature")) <= F.col("thr"), F.col("left")).otherwise(F.col("right"))
        walk = at.select("tree", key, "f", step.cast("int").alias("node"))
    leaves = walk.join(side, ["tree", "node"])
    return leaves.groupBy(key, "cls").agg((F.count(F.lit(1)) / F.lit(trees)).alias("p"))


def _assembled(samples: DataFrame, label: str):
    from pyspark.ml.functions import array_to_vector

    return samples.select("*", array_to_vector("f").alias("features"), F.col(label).cast("double").alias("label_"))


def train_boosting(samples: DataFrame, label: str = "cls", rounds: int = 20, seed: int = 42):
    """Boosted stumps (trees of depth 1)."""
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(featuresCol="features", labelCol="label_", maxDepth=1, maxIter=rounds, seed=seed).fit(_assembled(samples, label))


def train_forest(samples: DataFrame, label: str = "cls", trees: int = 16, depth: int = 8, per_class: int | None = None, seed: int = 42):
    """A random forest with sqrt(d) features a split; per_class draws about as many rows of every class."""
    from pyspark.ml.classification import RandomForestClassifier

    if per_class:
        sizes = {r[0]: r[1] for r in samples.groupBy(label).count().collect()}
        samples = samples.sampleBy(label, {c: min(1.0, per_class / n) for c, n in sizes.items()}, seed)
    return RandomForestClassifier(featuresCol="features", labelCol="label_", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed).fit(_assembled(samples, label))


def train_regression(samples: DataFrame, target: str, trees: int = 16, depth: int = 8, seed: int = 42):
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(featuresCol="features", labelCol="label_", numTrees=trees, maxDepth=depth, seed=seed).fit(_assembled(samples, target))


def predicted(model, samples: DataFrame, key: str = "id") -> DataFrame:
    """(key, prediction, p of class 1 for classifiers)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    # Tasks get a copy: a forest's training summary holds the session, which can't be sent once a query was observed in it.
    out = model.copy().transform(samples.withColumn("features", array_to_vector("f")))
    extra = [vector_to_array("probability")[1].alias("p")] if "probability" in out.columns else []
    return out.select(key, "prediction", *extra)


def proximity(model_leaves: DataFrame, key: str = "id") -> DataFrame:
    """(a, b, share): how often two samples share a leaf, of leaves(key, tree, leaf)."""
    trees = model_leaves.select("tree").distinct().count()
    a = model_leaves.select(F.col(key).alias("a"), "tree", "leaf")
    b = model_leaves.select(F.col(key).alias("b"), "tree", "leaf")
    return a.join(b, ["tree", "leaf"]).where("a < b").groupBy("a", "b").agg((F.count(F.lit(1)) / trees).alias("share"))


def on_tiles(image: DataFrame, size: int, halo: int, run) -> DataFrame:
    """(z, y, x, v): run(array of the tile with halo) -> array, on tiles of size x size; halos are cut off, beyond the image values mirror.

    image(z, y, x, v) is a stack of planes, each tiled for itself. A pixel is sent to every tile whose halo holds it (a narrow explode); a task holds one tile.
    """
    tile = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / size).cast("int"), F.floor((F.col(c) + halo) / size).cast("int")))
    spread = image.select("z", "y", "x", "v").withColumn("ty", tile("y")).withColumn("tx", tile("x")).where("ty >= 0 and tx >= 0")
    # A tile that holds halo alone is none.
    own = (F.floor(F.col("y") / size) == F.col("ty")) & (F.floor(F.col("x") / size) == F.col("tx"))
    spread = spread.withColumn("own", own)

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if not pdf["own"].any():
            return pd.DataFrame({"z": [], "y": [], "x": [], "v": []})
        y0, x0 = pdf["y"].min(), pdf["x"].min()
        a = np.zeros((pdf["y"].max() - y0 + 1, pdf["x"].max() - x0 + 1))
        a[pdf["y"] - y0, pdf["x"] - x0] = pdf["v"]
        ty, tx = key[1] * size, key[2] * size
        pad = [(halo - (ty - y0), halo - (y0 + a.shape[0] - min(ty + size, y0 + a.shape[0]))), (halo - (tx - x0), halo - (x0 + a.shape[1] - min(tx + size, x0 + a.shape[1])))]
        core = (min(ty + size, y0 + a.shape[0]) - ty, min(tx + size, x0 + a.shape[1]) - tx)
        out = run(np.pad(a, [(max(p, 0), max(q, 0)) for p, q in pad], "symmetric"))[halo : halo + core[0], halo : halo + core[1]]
        y, x = np.mgrid[ty : ty + core[0], tx : tx + core[1]]
        return pd.DataFrame({"z": np.full(y.size, key[0], np.int32), "y": y.ravel().astype(np.int32), "x": x.ravel().astype(np.int32), "v": out.ravel().astype(float)})

    return spread.groupBy("z", "ty", "tx").applyInPandas(one, "z int, y int, x int, v double")


def membrane_response(image: DataFrame, window: int = 19, width: int = 3, rotations: int = 8, size: int = 64) -> DataFrame:
    """(z, y, x, v): the largest normalised correlation with a dark line turned `rotations` ways."""
    templates = [kernels.membrane_template(window, width, 180 * k / rotations) for k in range(rotations)]
    return on_tiles(image, size, window // 2, lambda a: np.max([kernels.correlated(a, t) for t in templates], axis=0))


def vesicle_response(image: DataFrame, radii: tuple[int, ...] = (2, 3, 4, 5, 6), size: int = 64) -> DataFrame:
    """(z, y, x, v): the largest correlation with rings of several radii."""
    edge = max(radii) + 2
    y, x = np.mgrid[-edge : edge + 1, -edge : edge + 1]
    rings = [np.where(np.abs(np.hypot(y, x) - r) <= 0.75, -1.0, 1.0) for r in radii]
    return on_tiles(image, size, edge, lambda a: np.max([kernels.correlated(a, t) for t in rings], axis=0))


def network(image: DataFrame, layers: list[tuple[np.ndarray, np.ndarray]], head: tuple[np.ndarray, np.ndarray], size: int = 64) -> DataFrame:
    """(z, y, x, v): probability of class 1 of each pixel by a convolutional net without pooling and a softmax layer."""
    halo = sum(w.shape[2] // 2 for w, _ in layers)

    def run(a: np.ndarray) -> np.ndarray:
        x = a[None]
        for w, b in layers:
            x = kernels.convolution_layer(x, w, b)
        p = kernels.dense_layer(np.moveaxis(x, 0, -1), *head, last=True)[..., 1]
        return np.pad(p, halo)

    return on_tiles(image, size, halo, run)


def ensemble(parts: list[DataFrame]) -> DataFrame:
    """(z, y, x, v): the mean over networks."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("z", "y", "x").agg(F.avg("v").alias("v"))
