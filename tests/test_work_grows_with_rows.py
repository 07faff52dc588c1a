"""Steps whose work or memory went beyond their rows: values against plain readings, and plans or sizes that failed before."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoledger.functions import classes
from geoledger.operators import evaluation, layers, raster, scoring


def test_softmax_of_long_arrays(spark):
    """The total was summed again for each element, and the maximum for each of its terms."""
    rows = spark.range(40).select("id", F.transform(F.sequence(F.lit(0), F.lit(799)), lambda x: ((x * 7 + F.col("id")) % 11).cast("double")).alias("s"))
    got = {r["id"]: r["p"] for r in rows.select("id", classes.softmax(F.col("s")).alias("p")).collect()}
    for k, p in got.items():
        e = np.exp([(x * 7 + k) % 11 - 10.0 for x in range(800)])
        assert p == pytest.approx((e / e.sum()).tolist())
    assert spark.sql("select cast(null as array<double>) as s").select(classes.softmax(F.col("s")).alias("p")).first()["p"] is None


@pytest.mark.parametrize(("to_height", "to_width"), [(9, 8), (4, 5), (6, 7)])
def test_mirror_without_a_grid(spark, to_height, to_width):
    height, width = 6, 5
    rng = random.Random(1)
    cells = {(s, r, c): rng.randrange(50) for s in (1, 2) for r in range(height) for c in range(width) if rng.random() < 0.7}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "scene_id long, r long, c long, v int")
    out = raster.mirrored(df, "scene_id", "v", height, width, to_height, to_width)
    back = lambda x, n: 2 * (n - 1) - x if x >= n else x
    want = {(s, r, c): cells[s, back(r, height), back(c, width)] for s in (1, 2) for r in range(to_height) for c in range(to_width) if (s, back(r, height), back(c, width)) in cells}
    assert {(r["scene_id"], r["r"], r["c"]): r["v"] for r in out.collect()} == want
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_smoothing_against_a_fit_at_each_place(spark):
    ring = [(0.0, 0.0), (9.0, 0.0), (9.0, 4.0), (5.0, 7.5), (0.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [[{"x": x, "y": y} for x, y in ring]])], f"k long, rings {layers.RINGS}")
    got = [(p["x"], p["y"]) for p in layers.smoothed(df, "rings", 2.0).first()["rings"][0]]
    points = np.array(ring)
    along = np.concatenate(([0], np.cumsum(np.hypot(*np.diff(points, axis=0).T))))
    fine = np.linspace(0, along[-1], 320, endpoint=False)
    xy = np.stack([np.interp(fine, along, points[:, k]) for k in (0, 1)], 1)
    for place, at in zip(got, np.linspace(0, along[-1], 40, endpoint=False), strict=False):
        t = (fine - at + along[-1] / 2) % along[-1] - along[-1] / 2
        root = np.sqrt(np.exp(-((t / 2.0) ** 2)))
        assert place == pytest.approx(np.linalg.lstsq(np.stack((np.ones_like(t), t, t * t), 1) * root[:, None], xy * root[:, None], rcond=None)[0][0], abs=1e-6)
    assert len(got) == 41 and got[0] == got[-1]


def test_rotated_overlap_is_worked_out_once_and_in_plain_numbers(spark):
    boxes = spark.createDataFrame([(1, k, 5.0 + k, 5.0, 4.0, 2.0, 30.0 * k) for k in range(6)], "image long, box long, cx double, cy double, w double, h double, angle double")
    pairs = scoring.rotated_pairs(boxes, boxes, ["image"]).where("iou > 1e-6").select("a.box", F.round("iou", 5).alias("iou"))
    assert pairs._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert all(type(x) is float for p in scoring.corners(1.0, 2.0, 3.0, 4.0, 30.0) for x in p)
    assert scoring.corners(0.0, 0.0, 2.0, 1.0, 90.0) == [(0.5, -1.0), (0.5, 1.0), (-0.5, 1.0), (-0.5, -1.0)] or math.isclose(scoring.rotated_iou((0, 0, 2, 1, 90), (0, 0, 1, 2, 0)), 1)


def test_recall_counts_truths_without_a_row_for_each_threshold(spark):
    rows = [(1, 1, 0.2, 10, 5.0, 0.9), (1, 2, 0.9, None, None, None)]
    pairs = spark.createDataFrame(rows, "image long, det long, score double, truth long, truth_size double, iou double")
    truths = spark.createDataFrame([(10, 5.0), (11, 5.0), (11, 5.0)], "truth long, truth_size double")
    out = evaluation.proposal_recall(pairs, truths, ["image"], "det", "truth", [0.5, 0.95], [1, 2], {"all": (0, 100), "none": (200, 300)})
    assert {(r["area"], r["most"], r["threshold"]): round(r["recall"], 6) for r in out.collect()} == {
        ("all", 1, 0.5): 0.0, ("all", 1, 0.95): 0.0, ("all", 1, None): 0.0, ("all", 2, 0.5): 0.333333, ("all", 2, 0.95): 0.0, ("all", 2, None): 0.166667,
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    exploded = [k for k, line in enumerate(plan) if "Generate" in line and "0.95" in line]
    scans = [k for k, line in enumerate(plan) if "Join LeftOuter" in line]
    assert exploded and scans


def test_right_angles_give_exact_overlaps():
    """Shares at the edge of a rounding, as 7 / 64, come out as by whole numbers."""
    rng = random.Random(7)
    for _ in range(2000):
        (x, y, w, h), (u, v, k, m) = ([rng.randrange(40) / 2, rng.randrange(40) / 2, float(rng.randrange(1, 50)), float(rng.randrange(1, 43))] for _ in range(2))
        side = lambda a, n, b, o: max(0.0, min(a + n / 2, b + o / 2) - max(a - n / 2, b - o / 2))
        both = side(x, h, u, k) * side(y, w, v, m)
        assert scoring.rotated_iou((x, y, w, h, 90.0), (u, v, k, m, 180.0)) == (both / (w * h + k * m - both) if both else 0.0)
