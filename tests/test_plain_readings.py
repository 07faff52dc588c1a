"""Operators without an SQL twin against plain readings: best detections, panoptic merge, equalisation, smoothing."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from geoledger.functions.geometry import rectangle
from geoledger.operators import evaluation, layers, scoring


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    shared = max(w, 0) * max(h, 0)
    return shared / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared)


def test_best_detections(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        x, y = rng.randrange(-10, 60), rng.randrange(-10, 60)
        rows.append((rng.randrange(5), rng.randrange(3), k, rng.randrange(40) / 40, float(x), float(y), float(x + rng.randrange(0, 25)), float(y + rng.randrange(0, 25))))
    rows += [(0, 0, 900, 0.99, float("nan"), 0.0, 5.0, 5.0), (0, 0, 901, 0.99, 0.0, 0.0, float("inf"), 5.0)]
    df = spark.createDataFrame(rows, "image long, category long, id long, score double, x0 double, y0 double, x1 double, y1 double")
    found = {(r["image"], r["id"]): tuple(r[c] for c in ("x0", "y0", "x1", "y1")) for r in evaluation.best_detections(df, "image", "category", "id", 0.2, 0.5, 6, 50, 40).collect()}
    want = {}
    for image in range(5):
        kept = []
        for i, c, k, score, *box in sorted(rows, key=lambda r: (-r[3], r[2])):
            if i != image or score <= 0.2 or not np.isfinite(box).all():
                continue
            cut = tuple(min(max(v, 0.0), m) for v, m in zip(box, (50.0, 40.0, 50.0, 40.0), strict=True))
            if cut[2] > cut[0] and cut[3] > cut[1] and all(c != d or overlap(cut, other) <= 0.5 for d, _, other in kept):
                kept.append((c, k, cut))
        want |= {(image, k): cut for _, k, cut in kept[:6]}
    assert found == want and len(want) == 30


def test_panoptic_merge(spark):
    rng = random.Random(8)
    masks, semantic = [], []
    for scene in range(3):
        semantic += [(scene, r, c, (r // 6 + c // 6) % 4) for r in range(20) for c in range(20)]
        for k in range(12):
            y, x, h, w = rng.randrange(16), rng.randrange(16), rng.randrange(1, 8), rng.randrange(1, 8)
            score = rng.randrange(5) / 5
            masks += [(scene, k, score, r, c) for r in range(y, min(y + h, 20)) for c in range(x, min(x + w, 20))]
    found = evaluation.merged_segments(spark.createDataFrame(masks, "scene_id long, instance long, score double, r long, c long"), spark.createDataFrame(semantic, "scene_id long, r long, c long, cls long"), 0.5, 10).collect()
    want = set()
    for scene in range(3):
        grid: dict = {}
        scores = {m[1]: m[2] for m in masks if m[0] == scene}
        for k in sorted(scores, key=lambda k: (-scores[k], k)):
            own = {m[3:] for m in masks if m[:2] == (scene, k)}
            met = sum(cell in grid for cell in own)
            if met * 2 <= len(own) and met < len(own):
                grid |= {cell: k for cell in own if cell not in grid}
        want |= {(scene, "thing", k, sum(v == k for v in grid.values())) for k in set(grid.values())}
        left: dict = {}
        for s, r, c, cls in semantic:
            if s == scene and (r, c) not in grid:
                left[cls] = left.get(cls, 0) + 1
        want |= {(scene, "stuff", cls, n) for cls, n in left.items() if n >= 10}
    kinds = {r["kind"] for r in found}
    assert len(kinds) == 2
    assert {(r["scene_id"], r["id"], r["cells"]) for r in found} == {(s, k, n) for s, _, k, n in want} and len(found) == len(want)


def test_adaptive_equalisation():
    """Each cell by itself: the curves of the parts around it, weighed by its distance from their middles."""
    rng = np.random.default_rng(3)
    band = np.clip(rng.normal(90, 40, (24, 40)), 0, 255).astype(int)
    out = scoring.equalised(band, clip=2.0, grid=4)
    h, w = 6, 10

    def curve(i, j, value):
        part = band[i * h : (i + 1) * h, j * w : (j + 1) * w].ravel().tolist()
        most = max(1.0, 2.0 * len(part) / 256)
        counts = [part.count(v) for v in range(256)]
        over = sum(max(n - most, 0) for n in counts)
        return sum(min(n, most) + over / 256 for n in counts[: value + 1]) * 255 / len(part)

    for r, c in [(0, 0), (23, 39), (3, 5), (8, 17), (12, 20), (20, 2), (5, 30), (14, 14)]:
        y, x = min(max((r - (h - 1) / 2) / h, 0), 3), min(max((c - (w - 1) / 2) / w, 0), 3)
        i, j = min(int(y), 2), min(int(x), 2)
        fy, fx = y - i, x - j
        v = int(band[r, c])
        want = (1 - fy) * ((1 - fx) * curve(i, j, v) + fx * curve(i, j + 1, v)) + fy * ((1 - fx) * curve(i + 1, j, v) + fx * curve(i + 1, j + 1, v))
        assert abs(out[r, c] - want) <= 0.5 + 1e-6
    assert len(set(np.ptp(scoring.equalised(np.full((16, 16), 7)), axis=0))) == 1


def test_smoothed_rings(spark):
    """Sides far from a corner stay where they are, but for the kernel's weight at the corner; rings stay closed."""
    shape = spark.range(1).select(rectangle(*[F.lit(v) for v in (0, 0, 100, 60)]).alias("rings"))
    for tolerance in (2.0, 8.0):
        (ring,) = layers.smoothed(shape, "rings", tolerance, points=64).first()["rings"]
        xy = np.array([(p["x"], p["y"]) for p in ring])
        assert len(xy) == 65 and np.allclose(xy[0], xy[-1])
        off = 1e-6 + tolerance * np.exp(-((20 / tolerance) ** 2))
        for across, along, sides, middle in ((1, 0, (0, 60), 50), (0, 1, (0, 100), 30)):
            for side in sides:
                near = (np.abs(xy[:, along] - middle) < 10) & (np.abs(xy[:, across] - side) < 20)
                assert near.any() and np.abs(xy[near, across] - side).max() <= off
        area = abs(np.sum(xy[:-1, 0] * xy[1:, 1] - xy[1:, 0] * xy[:-1, 1])) / 2
        assert abs(area - 6000) < 4 * tolerance**2 + 10
