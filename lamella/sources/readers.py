"""Readers: image lists and files, feature sets, models, tiles, chunk maps, feature frames."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import digits_key, dominant_channel, packed_colour
from ..schema import assert_schema, schema_of


def image_list(spark: SparkSession, path: str) -> DataFrame:
    """(z, path): the lines of a list file; z is the line's place, found from byte order, not from row order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("z", "path"))
    return lines.where("trim(path) <> ''").select("z", F.trim("path").alias("path"))


def _gray(content: bytes) -> np.ndarray:
    """Pixels of a binary PGM (P5) or PPM (P6, mean of channels) file, or of an .npy array."""
    if content[:6] == b"\x93NUMPY":
        import io

        return np.load(io.BytesIO(content)).astype(float)
    fields, at = [], 0
    while len(fields) < 4:
        while content[at : at + 1].isspace():
            at += 1
        if content[at : at + 1] == b"#":
            at = content.index(b"\n", at)
            continue
        end = at
        while not content[end : end + 1].isspace():
            end += 1
        fields.append(content[at:end])
        at = end
    kind, width, height, most = fields[0], *map(int, fields[1:])
    pixels = np.frombuffer(content[at + 1 :], np.uint8 if most < 256 else ">u2").astype(float)
    return pixels.reshape(height, width) if kind == b"P5" else pixels.reshape(height, width, 3).mean(axis=2)


def gray_images(spark: SparkSession, folder: str, unit: bool = False) -> DataFrame:
    """(z, y, x, v) of the image files of a folder; z is the number in the name. unit scales values to [0, 1]."""
    files = spark.read.format("binaryFile").load(folder).select(digits_key(F.element_at(F.split("path", "/"), -1)).cast("int").alias("z"), "content")

    def decode(batches):
        for batch in batches:
            for z, content in zip(batch["z"], batch["content"]):
                v = _gray(bytes(content))
                y, x = np.mgrid[: v.shape[0], : v.shape[1]]
                yield pd.DataFrame({"z": np.int32(z), "y": y.ravel().astype(np.int32), "x": x.ravel().astype(np.int32), "v": v.ravel() / (255.0 if unit else 1.0)})

    return files.mapInPandas(decode, "z int, y int, x int, v double")


def features(df: DataFrame, names: list[str] | None = None, roi: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Wide feature rows: only the named columns are read, the region reaches the scan as filters."""
    for axis, (low, high) in (roi or {}).items():
        df = df.where((F.col(axis) >= low) & (F.col(axis) < high))
    return df.select("y", "x", *names) if names else df


def extent(df: DataFrame) -> DataFrame:
    return df.agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def feature_names(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c not in ("z", "y", "x"))


def colour_stack(df: DataFrame, alpha: bool = False) -> DataFrame:
    """(z, y, x, label) from channel columns r, g, b (a)."""
    return df.select("z", "y", "x", packed_colour(F.col("r"), F.col("g"), F.col("b"), F.col("a") if alpha else None).alias("label"))


def external_segmentations(df: DataFrame) -> DataFrame:
    """(z, seg, y, x, is_boundary): pixel value 0 is boundary; candidates are numbered by folder order."""
    return df.select("z", "seg", "y", "x", (F.col("v") == 0).alias("is_boundary"))


def quadrants(parts: list[tuple[DataFrame, int, int]]) -> DataFrame:
    """One plane from overlapping parts (df, y offset, x offset); the later part stands where they overlap."""
    out = None
    for i, (df, dy, dx) in enumerate(parts):
        moved = df.select("z", (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), F.struct(F.lit(i).alias("i"), F.col("v").alias("v")).alias("s"))
        out = moved if out is None else out.unionByName(moved)
    return out.groupBy("z", "y", "x").agg(F.max("s").alias("s")).select("z", "y", "x", F.col("s.v").alias("v"))


def stumps(spark: SparkSession, path: str) -> DataFrame:
    """(feature, thr, lo, hi) of lines `name <= thr ? lo : hi`."""
    pattern = r"^\s*(\S+)\s*<=\s*(\S+)\s*\?\s*(\S+)\s*:\s*(\S+)\s*$"
    part = lambda i: F.regexp_extract("value", pattern, i)
    return spark.read.text(path).where(F.col("value").rlike(pattern)).select(part(1).alias("feature"), *[part(i).cast("double").alias(n) for i, n in ((2, "thr"), (3, "lo"), (4, "hi"))])


def painted_labels(df: DataFrame) -> DataFrame:
    """(z, y, x, cls): pure green is 1, pure red is 0; other pixels carry no label."""
    green, red = "g = 255 and r = 0 and b = 0", "r = 255 and g = 0 and b = 0"
    return df.where(f"({green}) or ({red})").select("z", "y", "x", F.expr(f"cast(({green}) as int)").alias("cls"))


def dominant_labels(df: DataFrame) -> DataFrame:
    cls = dominant_channel(F.col("r"), F.col("g"), F.col("b"))
    return df.select("z", "y", "x", cls.alias("cls")).where("cls > 0")


def tiles_of(spark: SparkSession, index: DataFrame, w: int, label: int, planes: list[int]) -> DataFrame:
    """The tile index's rows of a scale and label in the given planes, by SQL."""
    return spark.sql("SELECT w, x, y, z FROM {index} WHERE w = {w} AND id = {label}", index=index, w=w, label=label).where(F.col("z").isin(planes))


def sift_frames(spark: SparkSession, path: str) -> DataFrame:
    """(frame, y, x, sigma, theta, descriptor) of a text file: a count and length line, then per frame four numbers and the descriptor over several lines."""
    numbers = spark.read.text(path, wholetext=True).select(F.filter(F.split("value", r"\s+"), lambda s: s != "").alias("n"))
    n, length = F.get("n", F.lit(0)).cast("int"), F.get("n", F.lit(1)).cast("int")
    frames = numbers.select("n", length.alias("len"), F.explode(F.sequence(F.lit(0), n - 1)).alias("frame"))
    at = (F.lit(3) + F.col("frame") * (F.col("len") + 4)).cast("int")
    part = frames.select("frame", F.transform(F.slice("n", at, F.col("len") + 4), lambda s: s.cast("double")).alias("v"), "len")
    return part.select("frame", *[F.col("v")[i].alias(c) for i, c in enumerate(("y", "x", "sigma", "theta"))], F.slice("v", F.lit(5), F.col("len")).alias("descriptor"))


def expanded(runs: DataFrame) -> DataFrame:
    """(z, y, x, label) of runs (z, y, x, n, label) along x: the inverse of writers.compressed."""
    return runs.withColumn("x", F.explode(F.sequence(F.col("x"), F.col("x") + F.col("n") - 1))).select("z", "y", "x", "label")


def forest(spark: SparkSession, path: str) -> DataFrame:
    """The node table of a forest that writers.forest_text wrote."""
    return assert_schema(spark.read.schema(schema_of("forest")).json(path), "forest")


def boosted_xml(path: str) -> list[tuple[int, float, float, float]]:
    """(feature, threshold, value up to it, value above it) of the stumps of a boosting model in OpenCV's XML.

    Trees are <_> elements below <trees>, their <nodes> a root with <splits> and two leaves with <value>. The file is one
    model, so it is read on the driver.
    """
    import xml.etree.ElementTree as ET

    out = []
    for nodes in ET.parse(path).getroot().iter("nodes"):
        split = nodes.find(".//splits/_")
        if split is None:
            continue
        leaves = [n for n in nodes if n.find("splits") is None]
        low, high = (float(n.findtext("value")) for n in leaves[:2])
        if split.findtext("le") is not None:
            threshold = float(split.findtext("le"))
        else:  # the comparison may be given the other way round
            threshold, low, high = float(split.findtext("gt")), high, low
        out.append((int(split.findtext("var")), threshold, low, high))
    return out
