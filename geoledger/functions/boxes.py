"""Boxes as columns x0, y0, x1, y1, and rotated boxes as centre, size and degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def to_xywh(b: Box) -> Box:
    return b[0], b[1], b[2] - b[0], b[3] - b[1]


def from_xywh(b: Box) -> Box:
    return b[0], b[1], b[0] + b[2], b[1] + b[3]


def rotated_from_xywh(b: Box) -> tuple[Column, ...]:
    """Centre x and y, width, height, and no rotation."""
    return b[0] + b[2] / 2, b[1] + b[3] / 2, b[2], b[3], F.lit(0.0)


def hull(cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> Box:
    """The upright box around a rotated one."""
    c, s = F.abs(F.cos(F.radians(degrees))), F.abs(F.sin(F.radians(degrees)))
    half_w, half_h = (c * w + s * h) / 2, (c * h + s * w) / 2
    return cx - half_w, cy - half_h, cx + half_w, cy + half_h


def wrapped_angle(degrees: Column) -> Column:
    """From -180, included, to 180."""
    return F.pmod(degrees + 180, F.lit(360.0)) - 180


def clipped(b: Box, width: float, height: float) -> Box:
    def to(v: Column, top: float) -> Column:
        return F.least(F.greatest(v, F.lit(0.0)), F.lit(float(top)))

    return to(b[0], width), to(b[1], height), to(b[2], width), to(b[3], height)


def scaled(b: Box, by_x: float, by_y: float) -> Box:
    return b[0] * by_x, b[1] * by_y, b[2] * by_x, b[3] * by_y


def centre(b: Box) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def is_not_empty(b: Box, least: float = 1e-5) -> Column:
    return (b[2] - b[0] > least) & (b[3] - b[1] > least)


def is_inside(b: Box, width: float, height: float, margin: float = 0) -> Column:
    """Inside the image with a margin; the upper bounds are strict."""
    return (b[0] >= -margin) & (b[1] >= -margin) & (b[2] < width + margin) & (b[3] < height + margin)


def is_finite(*values: Column) -> Column:
    out = F.lit(True)
    for v in values:
        out = out & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return out


def overlap(a: Box, b: Box) -> Column:
    """Area that two boxes share; 0 if they are apart."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def iou(a: Box, b: Box, extra: float = 0.0) -> Column:
    """Overlap by union; ``extra`` is added to all widths and heights (1 where boxes count their last pixel)."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0]) + extra
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1]) + extra
    both = F.when((w > 0) & (h > 0), w * h).otherwise(0.0)
    size = lambda x: (x[2] - x[0] + extra) * (x[3] - x[1] + extra)
    return F.when(both > 0, both / (size(a) + size(b) - both)).otherwise(0.0)


def ioa(a: Box, b: Box) -> Column:
    """Overlap by the second box's area."""
    both = overlap(a, b)
    return F.when(both > 0, both / area(b)).otherwise(0.0)
