"""Polygons as arrays of rings of (x, y) structs, the first ring outer; coordinates as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_RADIUS = 6378137.0


def to_world(gt: Column, col: Column, row: Column) -> tuple[Column, Column]:
    """World coordinates of a pixel's corner, by the six numbers of a geo-transform with rotation."""
    g = [F.get(gt, F.lit(i)) for i in range(6)]
    return g[0] + col * g[1] + row * g[2], g[3] + col * g[4] + row * g[5]


def window_transform(gt: Column, x: Column, y: Column) -> Column:
    """The geo-transform of a window that begins at pixel (x, y)."""
    left, top = to_world(gt, x, y)
    g = [F.get(gt, F.lit(i)) for i in range(6)]
    return F.array(left, g[1], g[2], top, g[4], g[5])


def to_pixel(gt: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Column and row of a point, cut to whole numbers; transforms without rotation."""
    g = [F.get(gt, F.lit(i)) for i in range(6)]
    return ((x - g[0]) / g[1]).cast("long"), ((y - g[3]) / g[5]).cast("long")


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to web-mercator metres."""
    return lon * (math.pi * _RADIUS / 180), F.log(F.tan((lat + 90) * (math.pi / 360))) * _RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Web-mercator metres to degrees."""
    return x * (180 / (math.pi * _RADIUS)), F.atan(F.exp(y / _RADIUS)) * (360 / math.pi) - 90


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A polygon of one closed ring."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0)))


def _pairs(ring: Column) -> Column:
    n = F.size(ring)
    return F.arrays_zip(F.slice(ring, 1, n - 1).alias("a"), F.slice(ring, 2, n - 1).alias("b"))


def ring_area(ring: Column) -> Column:
    """Area within a closed ring, whichever way it turns."""
    double = F.aggregate(_pairs(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.abs(double) / 2


def polygon_area(rings: Column) -> Column:
    """Area of the outer ring less its holes."""
    total = F.aggregate(F.transform(rings, ring_area), F.lit(0.0), lambda s, a: s + a)
    return 2 * ring_area(F.get(rings, F.lit(0))) - total


def ring_length(ring: Column) -> Column:
    step = lambda s, e: s + F.sqrt(F.pow(e["b"]["x"] - e["a"]["x"], 2) + F.pow(e["b"]["y"] - e["a"]["y"], 2))
    return F.aggregate(_pairs(ring), F.lit(0.0), step)


def without_holes(rings: Column) -> Column:
    return F.slice(rings, 1, 1)


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside by the even-odd rule over all rings."""

    def crossings(ring: Column) -> Column:
        def one(s: Column, e: Column) -> Column:
            a, b = e["a"], e["b"]
            spans = (a["y"] > y) != (b["y"] > y)
            return s + F.when(spans & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0)

        return F.aggregate(_pairs(ring), F.lit(0), one)

    total = F.aggregate(F.transform(rings, crossings), F.lit(0), lambda s, n: s + n)
    return total % 2 == 1


def to_wkt(rings: Column) -> Column:
    """POLYGON text."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")"))


def from_wkt(wkt: Column) -> Column:
    """Rings of a POLYGON text; null for an empty one or another kind."""
    inner = F.regexp_extract(wkt, r"(?i)^\s*POLYGON\s*\(\s*\((.*)\)\s*\)\s*$", 1)
    numbers = lambda v: F.split(F.trim(v), r"\s+")
    point = lambda v: F.struct(F.get(numbers(v), F.lit(0)).cast("double").alias("x"), F.get(numbers(v), F.lit(1)).cast("double").alias("y"))
    rings = F.transform(F.split(inner, r"\)\s*,\s*\("), lambda r: F.transform(F.split(r, ","), point))
    return F.when(inner != "", rings)
