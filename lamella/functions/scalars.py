"""Scalar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Exponent of an area's worth, and the loss a step of link distance.
WORTH_POWER = 0.9
DISTANCE_FACTOR = 0.75


def segment_worth(area: Column) -> Column:
    return F.pow(area, F.lit(WORTH_POWER))


def link_worth(a1: Column, a2: Column, ov: Column, dz: Column | None = None) -> Column:
    worth = ov / F.greatest(a1, a2) * F.pow(F.least(a1, a2), F.lit(WORTH_POWER))
    return worth if dz is None else worth * F.pow(F.lit(DISTANCE_FACTOR), dz - 1)


def link_worth_with_segments(a1: Column, a2: Column, ov: Column) -> Column:
    """The links-only objective: the link's worth and the mean of its segments'."""
    return link_worth(a1, a2, ov) + (segment_worth(a1) + segment_worth(a2)) / 2


def clique_link_cost(size1: Column, size2: Column, forward: Column, backward: Column, power: float, least_max: float, least_min: float, penalty: float = 0.2) -> Column:
    """max(forward, backward) * min(size) ** power; links under either threshold cost -penalty."""
    most, least = F.greatest(forward, backward), F.least(forward, backward)
    return F.when((most < least_max) | (least < least_min), F.lit(-penalty)).otherwise(most * F.pow(F.least(size1, size2), F.lit(power)))


def packed_id(label: Column, block: Column) -> Column:
    """label with the block in the upper 32 bits; background stays 0."""
    return F.when(label > 0, F.shiftleft(block.cast("long"), 32).bitwiseOR(label.cast("long"))).otherwise(F.lit(0).cast("long"))


def pair_id(a: Column, b: Column) -> Column:
    return F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long"))


def unpacked_pair(pair: Column) -> tuple[Column, Column]:
    return F.shiftright(pair, 32), pair.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def block_id(bx: Column, by: Column, bz: Column, nx: int, ny: int) -> Column:
    return bx + by * nx + bz * nx * ny


def logistic(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def inverted_integer(p: Column) -> Column:
    return F.floor((1 - p) * 2147483648).cast("long")


def terminal_weights(p: Column, threshold: float) -> tuple[Column, Column]:
    up = F.when(p >= threshold, 2 * (p - threshold)).otherwise(0.0)
    return up, F.when(p >= threshold, 0.0).otherwise(-2 * (p - threshold))


def gaussian_affinity(difference: Column, sigma: float) -> Column:
    return F.exp(-0.5 * difference * difference / (sigma * sigma)) / (sigma * math.sqrt(2 * math.pi))


def directional_affinity(orientation: Column, p: Column, offset: float, sigma: float, step: Column) -> Column:
    return F.abs(orientation) * F.exp(-0.5 * (p - offset) * (p - offset) / (sigma * sigma)) / step


def rounded_orientations(responses: list[Column]) -> list[Column]:
    """The largest (at least 0) of the responses within 22.5 degrees of 0, 45, 90 and 135, modulo 180."""
    step = 180.0 / len(responses)
    out = []
    for axis in (0.0, 45.0, 90.0, 135.0):
        near = [r for i, r in enumerate(responses) if min(abs(axis - step * i), abs(axis - step * i + 180), abs(axis - step * i - 180)) <= 22.5]
        out.append(F.greatest(F.lit(0.0), *near))
    return out


def sdbm(text: Column) -> Column:
    """The sdbm hash of a string modulo 2**32; 0 for the empty string."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), lambda h, c: F.pmod(F.ascii(c).cast("long") + h * 65599, F.lit(4294967296).cast("long")))


def digits_key(name: Column) -> Column:
    """The digits of a file name as a number; null without any."""
    digits = F.regexp_replace(name, "[^0-9]", "")
    return F.when(digits != "", digits.cast("long"))


def hms(seconds: Column) -> Column:
    """Seconds as text: `1h 2m 3s`, `2m 3s` or `3s`."""
    h, m, s = F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60
    text = F.when(h > 0, F.concat(h.cast("string"), F.lit("h "), m.cast("string"), F.lit("m "), s.cast("string"), F.lit("s")))
    return text.when(m > 0, F.concat(m.cast("string"), F.lit("m "), s.cast("string"), F.lit("s"))).otherwise(F.concat(s.cast("string"), F.lit("s")))


def id_list(text: Column) -> tuple[Column, Column]:
    """`primary:a,b` as (primary, [a, b])."""
    parts = F.split(text, ":")
    rest = F.get(parts, F.lit(1))
    return F.get(parts, F.lit(0)).cast("long"), F.transform(F.filter(F.split(F.coalesce(rest, F.lit("")), ","), lambda s: s != ""), lambda s: s.cast("long"))


def packed_colour(r: Column, g: Column, b: Column, a: Column | None = None) -> Column:
    value = F.shiftleft(r.cast("long"), 16) + F.shiftleft(g.cast("long"), 8) + b.cast("long")
    return value if a is None else value + F.shiftleft(a.cast("long"), 24)


def dominant_channel(r: Column, g: Column, b: Column) -> Column:
    """1, 2 or 3 for the strictly largest of r, g, b; 0 without one."""
    return F.when((r > g) & (r > b), 1).when((g > r) & (g > b), 2).when((b > r) & (b > g), 3).otherwise(0)
