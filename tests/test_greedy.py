"""Greedy work in the order of keys, rotated suppression, and matching at the bound."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from geoledger.operators import evaluation, scoring


def test_keys_over_several_batches_stay_whole(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(1)
        rows = [(rng.choice([1, 2, 3, 4, 5, None]), k) for k in range(400)]
        df = spark.createDataFrame(rows, "image long, v long")
        each = lambda image, v: [(image[0], len(v), sum(v))]
        found = evaluation._by_image(df, ["image"], each, "image long, n long, total long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {i: (sum(r[0] == i for r in rows), sum(r[1] for r in rows if r[0] == i)) for i in {r[0] for r in rows}}
    assert {r["image"]: (r["n"], r["total"]) for r in found} == want and len(found) == len(want)


def test_rotated_suppression_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(k % 3, k, rng.randrange(100) / 100, rng.random() * 30, rng.random() * 30, 4 + rng.random() * 12, 4 + rng.random() * 12, rng.random() * 360) for k in range(150)]
    df = spark.createDataFrame(rows, "image long, box long, score double, cx double, cy double, w double, h double, angle double")
    found = {r["box"] for r in evaluation.suppressed_rotated(df, ["image"], "box", 0.2).collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (-r[2], r[1])):
        if all(k[0] != r[0] or scoring.rotated_iou(r[3:], k[3:]) <= 0.2 for k in kept):
            kept.append(r)
    assert found == {r[1] for r in kept} and len(kept) < len(rows)


@pytest.mark.parametrize(("angle", "want"), [(0, 1.0), (90, 1 / 3), (180, 1.0), (45, None)])
def test_rotated_overlap_of_a_two_by_one_box(angle, want):
    found = scoring.rotated_iou((0, 0, 2, 1, 0), (0, 0, 2, 1, angle))
    if want is None:
        # By counting points on a fine grid.
        x, y = np.meshgrid((np.arange(1200) + 0.5) / 400 - 1.5, (np.arange(1200) + 0.5) / 400 - 1.5)
        u, v = (x + y) / 2**0.5, (y - x) / 2**0.5
        a, b = (abs(x) < 1) & (abs(y) < 0.5), (abs(u) < 1) & (abs(v) < 0.5)
        assert found == pytest.approx((a & b).sum() / (a | b).sum(), abs=2e-3)
    else:
        assert found == pytest.approx(want)


@pytest.mark.parametrize("method", ["iou", "assignment"])
def test_a_box_that_overlaps_just_enough_is_followed(spark, method):
    rows = [(1, 0, 1, 0.0, 0.0, 3.0, 1.0), (1, 1, 2, 1.0, 0.0, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "video long, frame long, box long, x0 double, y0 double, x1 double, y1 double")
    found = {r["box"]: r["track"] for r in scoring.tracked(df, "video", "frame", "box", least=0.5, method=method).collect()}
    assert found[1] == found[2]


def test_claims_leave_out_difficult_truths(spark):
    pairs = pd.DataFrame(
        [(1, 0, 10, 0.9, 1, 0.8, False), (1, 0, 11, 0.8, 1, 0.7, False), (1, 0, 12, 0.7, 2, 0.9, True), (1, 0, 13, 0.6, 2, 0.1, True), (1, 0, 14, 0.5, None, None, None)],
        columns=["image", "category", "det", "score", "truth", "iou", "difficult"],
    )
    df = spark.createDataFrame(pairs.astype(object).where(pairs.notna(), None), "image long, category long, det long, score double, truth long, iou double, difficult boolean")
    found = {r["det"]: r["tp"] for r in evaluation.claims(df, "image", "category", "det", "truth", 0.5).collect()}
    assert found == {10: 1, 11: 0, 13: 0, 14: 0}


def test_overflow_takes_the_largest_value_of_the_band_before():
    pre, post = np.full((8, 8), 10.0), np.full((8, 8), 250.0)
    pre[0, 0], post[4:, 4:] = 200.0, 90_000.0
    out = scoring.low_frequencies_of(pre, post)
    assert out.max() <= 255 and (out == 200).sum() > 1


def test_ranges_of_areas_against_a_plain_reading(spark):
    """One image: each range's own truths first, others don't count, nor do lone detections out of range."""
    rows = [(1, 1, 0.9, 5.0, 10, 5.0, 0.6), (1, 1, 0.9, 5.0, 11, 50.0, 0.8), (1, 2, 0.8, 50.0, 11, 50.0, 0.7), (1, 3, 0.7, 5.0, None, None, None), (1, 4, 0.6, 50.0, None, None, None)]
    df = spark.createDataFrame(rows, "image long, det long, score double, det_size double, truth long, truth_size double, iou double")
    found = evaluation.greedy_matches(df, ["image"], "det", "truth", [0.5], {"all": (0, 100), "small": (0, 10), "large": (10, 100)}).collect()
    by = {(r["area"], r["det"]): r["tp"] for r in found}
    assert by == {("all", 1): 1, ("all", 2): 0, ("all", 3): 0, ("all", 4): 0, ("small", 1): 1, ("small", 3): 0, ("large", 1): 1, ("large", 2): 0, ("large", 4): 0}
    assert {r["det"]: r["place"] for r in found} == {1: 1, 2: 2, 3: 3, 4: 4}
    counts = spark.createDataFrame([(0, "all", 2), (1, "all", 3)], "cat long, area string, truths long")
    scores = evaluation.coco_precision(spark.createDataFrame([(0, 1, 0.9, "all", 0.5, 1, 1), (0, 2, 0.8, "all", 0.5, 2, 0), (0, 3, 0.7, "all", 0.5, 3, 1)], "cat long, det long, score double, area string, threshold double, place int, tp int"), counts, "cat", "det", [0.5], {"all": [1, 100]})
    got = {(r["cat"], r["most"]): (round(r["ap"], 9), r["ar"]) for r in scores.collect()}
    assert got == {(0, 1): (round(51 / 101, 9), 0.5), (0, 100): (round((51 + 50 * 2 / 3) / 101, 9), 1.0), (1, 1): (0.0, 0.0), (1, 100): (0.0, 0.0)}


def test_proposals_cover_truths_by_area_and_number(spark):
    rows = [(1, 1, 0.2, 10, 5.0, 0.9), (1, 1, 0.2, 11, 50.0, 0.0), (1, 2, 0.9, 10, 5.0, 0.6), (1, 2, 0.9, 11, 50.0, 0.55)]
    pairs = spark.createDataFrame(rows, "image long, det long, score double, truth long, truth_size double, iou double")
    truths = spark.createDataFrame([(10, 5.0), (11, 50.0), (12, 50.0)], "truth long, truth_size double")
    out = evaluation.proposal_recall(pairs, truths, ["image"], "det", "truth", [0.5, 0.8], [1, 100], {"all": (0, 100), "large": (10, 100)}).collect()
    got = {(r["area"], r["most"], r["threshold"]): round(r["recall"], 9) for r in out}
    third = round(1 / 3, 9)
    assert got[("all", 1, 0.5)] == third and got[("all", 1, 0.8)] == 0 and got[("all", 1, None)] == round(1 / 6, 9)
    assert got[("all", 100, 0.5)] == round(2 / 3, 9) and got[("all", 100, 0.8)] == third
    assert got[("large", 1, 0.5)] == 0.5 and got[("large", 100, 0.8)] == 0 and len(got) == 12


def test_best_proposals_against_all_pairs(spark):
    rng = random.Random(9)
    rows = []
    for k in range(300):
        x, y = rng.random() * 40, rng.random() * 40
        rows.append((k % 3, k % 4, k, rng.randrange(100) / 100, x, y, x + 1 + rng.random() * 15, y + 1 + rng.random() * 15))
    df = spark.createDataFrame(rows, "image long, level long, box long, score double, x0 double, y0 double, x1 double, y1 double")
    found = {r["box"] for r in evaluation.best_proposals(df, "image", "level", "box", 12, 0.3, 9, 2.0).collect()}
    want = set()
    for image in range(3):
        kept = []
        for level in range(4):
            best = sorted((r for r in rows if r[:2] == (image, level)), key=lambda r: (-r[3], r[2]))[:12]
            own = []
            for r in (r for r in best if r[6] - r[4] > 2 and r[7] - r[5] > 2):
                over = lambda a, b: max(0, min(a[6], b[6]) - max(a[4], b[4])) * max(0, min(a[7], b[7]) - max(a[5], b[5]))
                if all(over(r, o) <= 0.3 * (over(r, r) + over(o, o) - over(r, o)) for o in own):
                    own.append(r)
            kept += own
        want |= {r[2] for r in sorted(kept, key=lambda r: (-r[3], r[2]))[:9]}
    assert found == want and len(want) == 27


def test_curves_over_slices_are_those_of_one_sorted_list(spark):
    rng = random.Random(3)
    rows = [(k % 2, k, rng.choice([0.0, 0.5, 0.5001, 1.0, rng.random()]), int(rng.random() < 0.4)) for k in range(400)]
    truths = spark.createDataFrame([(0, 90), (1, 200)], "cat long, truths long")
    found = {r["det"]: r for r in evaluation.precision_recall(spark.createDataFrame(rows, "cat long, det long, score double, tp int"), truths, "cat", "det").collect()}
    assert len(found) == 400
    for cat, n in ((0, 90), (1, 200)):
        order, tps, run = sorted((r for r in rows if r[0] == cat), key=lambda r: (-r[2], r[1])), 0, []
        for seen, r in enumerate(order, 1):
            tps += r[3]
            run.append((r[1], tps / n, tps / seen))
        for at, (det, recall, precision) in enumerate(run):
            got = found[det]
            assert (got["recall"], got["precision"], got["envelope"]) == pytest.approx((recall, precision, max(p for _, _, p in run[at:])))


def plain_matches(dets, truths, iou, threshold, low, high):
    """{det: tp} of the public matching of one image: truths that don't count come last, crowds can be taken again."""
    ignored = {t: crowd or not low <= size <= high for t, size, crowd in truths}
    out, taken = {}, set()
    for d, _, size in sorted(dets, key=lambda x: (-x[1], x[0])):
        best = max(((not ignored[t], iou[d, t], -t) for t, _, crowd in truths if (d, t) in iou and iou[d, t] >= threshold and (crowd or t not in taken)), default=None)
        if best is not None:
            taken.add(-best[2])
            if best[0]:
                out[d] = 1
        elif low <= size <= high:
            out[d] = 0
    return out


@pytest.mark.parametrize("base", [0, 1 << 60])
def test_crowds_and_large_ids(spark, base):
    """Running ids above 2^53, rows with null truths among them, and crowds."""
    rng = random.Random(7)
    rows, images = [], {}
    for image in range(6):
        dets = [(base + 100 * image + k, rng.randrange(50) / 50, rng.choice([5.0, 50.0])) for k in range(12)]
        truths = [(base + 100 * image + 50 + k, rng.choice([5.0, 50.0]), k % 3 == 0) for k in range(6)]
        iou = {(d, t): rng.randrange(40, 100) / 100 for d, _, _ in dets for t, _, _ in truths if rng.random() < 0.4}
        images[image] = (dets, truths, iou)
        for d, score, size in dets:
            met = [(t, ts, iou[d, t], crowd) for t, ts, crowd in truths if (d, t) in iou]
            rows += [(image, d, score, size, *m) for m in met] or [(image, d, score, size, None, None, None, None)]
    df = spark.createDataFrame(rows, "image long, det long, score double, det_size double, truth long, truth_size double, iou double, crowd boolean")
    areas = {"all": (0, 1e9), "small": (0, 10)}
    found = {(r["image"], r["det"], r["area"], r["threshold"]): r["tp"] for r in evaluation.greedy_matches(df, ["image"], "det", "truth", [0.5, 0.75], areas).collect()}
    want = {(i, d, a, t): tp for i, of in images.items() for a, (low, high) in areas.items() for t in (0.5, 0.75) for d, tp in plain_matches(*of, t, low, high).items()}
    assert found == want and 0 < sum(want.values()) < len(want)


def test_two_truths_with_neighbouring_large_ids(spark):
    base = 1 << 60
    rows = [(0, base + 10, 0.9, base + 1, 0.9), (0, base + 11, 0.8, base + 2, 0.9), (0, base + 12, 0.7, None, None)]
    df = spark.createDataFrame(rows, "image long, det long, score double, truth long, iou double")
    assert {r["det"] - base: r["tp"] for r in evaluation.greedy_matches(df, ["image"], "det", "truth", [0.5]).collect()} == {10: 1, 11: 1, 12: 0}


def test_mask_overlaps_against_sets_of_cells(spark):
    rng = random.Random(4)
    cells = {("d", i): {(rng.randrange(6), c) for _ in range(4) for s in [rng.randrange(150)] for c in range(s, s + rng.randrange(1, 90))} for i in range(5)}
    cells |= {("t", i): {(rng.randrange(6), c) for _ in range(4) for s in [rng.randrange(150)] for c in range(s, s + rng.randrange(1, 90))} for i in range(5)}

    def runs(side):
        rows = []
        for (k, i), own in cells.items():
            for r, c in sorted(own if k == side else ()):
                if (r, c - 1) not in own:
                    end = c
                    while (r, end + 1) in own:
                        end += 1
                    rows.append((1, (1 << 60) + i, r, c, end, i == 2))
        return rows

    dets = spark.createDataFrame([r[:5] for r in runs("d")], "image long, det long, r int, c0 int, c1 int")
    truths = spark.createDataFrame(runs("t"), "image long, truth long, r int, c0 int, c1 int, crowd boolean")
    found = {(r["det"] - (1 << 60), r["truth"] - (1 << 60)): r["iou"] for r in evaluation.mask_overlaps(dets, truths, ["image"], "det", "truth", crowd="crowd", tile=16).collect()}
    want = {}
    for i in range(5):
        for j in range(5):
            a, b = cells["d", i], cells["t", j]
            if a & b:
                want[i, j] = len(a & b) / (len(a) if j == 2 else len(a | b))
    assert found == pytest.approx(want) and len(want) > 5


def test_similarity_of_key_points(spark):
    sigmas = [0.1, 0.2, 0.05]
    dets = spark.createDataFrame([(1, 10, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0]), (1, 11, [9.0, 9.0, 9.0], [0.0, 0.0, 0.0])], "image long, det long, xs array<double>, ys array<double>")
    rows = [(1, 20, [1.0, 2.5, 0.0], [1.0, 2.0, 0.0], [2, 1, 0], 30.0, 0.0, 0.0, 4.0, 4.0), (1, 21, [0.0] * 3, [0.0] * 3, [0, 0, 0], 30.0, 0.0, 0.0, 4.0, 4.0)]
    truths = spark.createDataFrame(rows, "image long, truth long, xs array<double>, ys array<double>, vs array<int>, truth_size double, x0 double, y0 double, x1 double, y1 double")
    found = {(r["det"], r["truth"]): r["iou"] for r in evaluation.keypoint_similarity(dets, truths, ["image"], "det", "truth", sigmas).collect()}
    e = lambda d2, s: np.exp(-d2 / (2 * 30 * (2 * s) ** 2))
    want = {(10, 20): (1 + e(0.25, 0.2)) / 2, (11, 20): (e(64 + 1, 0.1) + e(6.5**2 + 4, 0.2)) / 2, (10, 21): 1.0, (11, 21): np.mean([e(1.0, s) for s in sigmas])}
    assert found == pytest.approx(want)
