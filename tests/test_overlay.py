"""Overlaps on a hierarchy of grids against all pairs."""

from __future__ import annotations

import random

import pytest

from geoledger.operators import overlay

BOX = "k long, g long, x0 double, y0 double, x1 double, y1 double"


def boxes(rng, n):
    out = []
    for k in range(n):
        side = 2.0 ** rng.randrange(-12, 14)
        x, y = rng.uniform(-50, 50) * rng.choice([1, 100]), rng.uniform(-50, 50)
        out.append((k, k % 2, x, y, x + side * rng.random(), y + side * rng.choice([1.0, 0.01, 0.0])))
    # On cell borders, next to each other, of all sizes; without area; not finite.
    out += [(n + k, 0, 0.0, 0.0, 2.0**k, 2.0**k) for k in range(-3, 6)] + [(n + 20, 0, 4.0, 0.0, 8.0, 4.0), (n + 21, 1, -4.0, -4.0, 0.0, 0.0)]
    return [*out, (n + 30, 0, float("nan"), 0.0, 1.0, 1.0), (n + 31, 0, None, 0.0, 1.0, 1.0), (n + 32, 1, 0.0, 0.0, float("inf"), 1.0), out[0], out[0]]


def plain(a, b, keys):
    fine = lambda r: all(v is not None and abs(v) < float("inf") for v in r[2:])
    out = []
    for p in filter(fine, a):
        for q in filter(fine, b):
            w, h = min(p[4], q[4]) - max(p[2], q[2]), min(p[5], q[5]) - max(p[3], q[3])
            if w > 0 and h > 0 and (not keys or p[1] == q[1]):
                out.append((p[0], q[0], w * h))
    return sorted(out)


@pytest.mark.parametrize("keys", [None, ["g"]])
def test_overlaps_of_boxes_of_all_sizes(spark, keys):
    rng = random.Random(8)
    a, b = boxes(rng, 150), boxes(rng, 130)
    pairs = overlay.overlapping(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), keys)
    found = sorted((r["i"], r["j"], r["shared"]) for r in pairs.selectExpr("a.k as i", "b.k as j", "shared").collect())
    want = plain(a, b, keys)
    assert [f[:2] for f in found] == [w[:2] for w in want] and len(want) > 300
    assert [f[2] for f in found] == pytest.approx([w[2] for w in want])


def test_few_rows_a_box(spark):
    """A box as large as a million small ones has a few rows for each level, not one for each of their cells."""
    large = overlay._level(spark.createDataFrame([(0, 0, 0.0, 0.0, 1e6, 1e6)], BOX))
    small = overlay._level(spark.createDataFrame([(k, 0, float(k), 0.0, k + 1.0, 1.0) for k in range(50)], BOX))
    assert overlay._cells(overlay._at_levels(large, small, above=False)).count() == 0
    assert overlay._cells(large).count() <= 9 and overlay._cells(overlay._at_levels(small, large, above=True)).count() <= 100


def test_nothing_meets_nothing(spark):
    none, one = spark.createDataFrame([], BOX), spark.createDataFrame([(0, 0, 0.0, 0.0, 1.0, 1.0)], BOX)
    for a, b in ((none, one), (one, none), (none, none)):
        assert overlay.overlapping(a, b).isEmpty()


def test_strangers_get_the_first_truth_of_their_image(spark):
    pairs = spark.createDataFrame([(1, 10, 20, 0.5)], "image long, det long, truth long, iou double")
    dets = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "image long, det long")
    truths = spark.createDataFrame([(1, 20), (1, 19)], "image long, truth long")
    found = sorted(tuple(r) for r in overlay.with_strangers(pairs, dets, truths, ["image"], "det", "truth").collect())
    assert found == [(1, 10, 20, 0.5), (1, 11, 19, 0.0)]


@pytest.mark.parametrize("crowd", [0, 140, 1000])
def test_keys_alone_or_grids_give_the_same(spark, monkeypatch, crowd):
    """Whether all, some or no keys are crowded; rows without a pair come once, those without a key or a finite box too."""
    monkeypatch.setattr(overlay, "CROWD", crowd)
    rng = random.Random(4)
    a, b = [(k, *r[1:]) for k, r in enumerate(boxes(rng, 90))] + [(500, None, 0.0, 0.0, 1.0, 1.0), (501, 7, 0.0, 0.0, 1.0, 1.0)], boxes(rng, 60) + [(900 + k, 0, 0.0, 0.0, 1.0, 1.0) for k in range(60)]
    left, right = spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX)
    pairs = [w[:2] for w in plain([r for r in a if r[1] is not None], b, ["g"])]
    assert sorted((r["i"], r["j"]) for r in overlay.overlapping(left, right, ["g"]).selectExpr("a.k as i", "b.k as j").collect()) == pairs
    found = overlay.pairwise_or_alone(left, right, ["g"], "k").selectExpr("a.k as i", "b.k as j", "iou").collect()
    assert sorted((r["i"], r["j"]) for r in found if r["j"] is not None) == pairs
    assert sorted(r["i"] for r in found if r["j"] is None) == sorted({r[0] for r in a} - {p[0] for p in pairs})
    assert all((r["j"] is None) == (r["iou"] is None) for r in found)


def test_small_keys_take_one_row_a_box(spark):
    """Boxes of keys that few share aren't copied for cells and levels before they are dealt."""
    rng = random.Random(2)
    left, right = spark.createDataFrame(boxes(rng, 40), BOX), spark.createDataFrame(boxes(rng, 40), BOX)
    plan = overlay.overlapping(left, right, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Union" not in plan
