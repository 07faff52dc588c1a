"""Scores where images are judged for some categories only, against a plain reading."""

from __future__ import annotations

import random

import pytest

from geoledger.operators import evaluation

BASE = 1 << 60


def plain(dets, truths, quality, negatives, partial, thresholds, most):
    scores = {}
    kept = []
    for image in {d[0] for d in dets}:
        kept += sorted((d for d in dets if d[0] == image), key=lambda d: (-d[3], d[2]))[:most]
    judged = {t[:2] for t in truths} | negatives
    kept = [d for d in kept if d[:2] in judged]
    for category in {t[1] for t in truths}:
        total, own = sum(t[1] == category for t in truths), []
        for least in thresholds:
            used, row = set(), []
            for image, c, det, score in sorted(kept, key=lambda d: (-d[3], d[2])):
                if c != category:
                    continue
                free = [(-quality[det, t[2]], t[2]) for t in truths if t[:2] == (image, c) and quality.get((det, t[2]), 0) >= least and t[2] not in used]
                if free:
                    used.add(min(free)[1])
                if free or (image, c) not in partial:
                    row.append(bool(free))
            hits = [sum(row[: k + 1]) for k in range(len(row))]
            curve = [(h / total, h / (k + 1)) for k, h in enumerate(hits)]
            own.append(sum(max((p for r, p in curve if r >= i / 100 - 1e-12), default=0.0) for i in range(101)) / 101)
        scores[category] = sum(own) / len(own)
    return scores


@pytest.mark.parametrize("most", [4, 300])
def test_against_a_plain_reading(spark, most):
    rng = random.Random(3)
    dets = [(rng.randrange(12), rng.randrange(4), BASE + k, rng.randrange(50) / 50) for k in range(160)]
    truths = [(rng.randrange(12), rng.randrange(4), BASE + 1000 + k) for k in range(70)] + [(3, 9, BASE + 2000)]
    quality = {(d[2], t[2]): rng.randrange(40, 100) / 100 for d in dets for t in truths if d[:2] == t[:2] and rng.random() < 0.8}
    negatives = {(i, c) for i in range(12) for c in range(4) if (i + c) % 3 == 0} - {t[:2] for t in truths}
    partial = {(i, c) for i in range(12) for c in range(4) if (i + c) % 4 == 0}
    key = "image long, category long"
    out = evaluation.federated_precision(
        spark.createDataFrame(dets, f"{key}, det long, score double"),
        spark.createDataFrame(truths, f"{key}, truth long"),
        spark.createDataFrame([(d, t, q) for (d, t), q in quality.items()], "det long, truth long, iou double"),
        spark.createDataFrame([*negatives, *negatives], key),
        spark.createDataFrame(list(partial), key),
        "image", "category", "det", "truth", [0.5, 0.75, 0.9], most,
    )
    want = plain(dets, truths, quality, negatives, partial, [0.5, 0.75, 0.9], most)
    assert {r["category"]: round(r["ap"], 9) for r in out.collect()} == {c: round(v, 9) for c, v in want.items()}
    assert want[9] == 0 and sum(want.values()) > 0.3


def test_no_rows(spark):
    key = "image long, category long"
    empty = lambda kind: spark.createDataFrame([], kind)
    args = (empty(f"{key}, truth long"), empty("det long, truth long, iou double"), empty(key), empty(key), "image", "category", "det", "truth", [0.5])
    assert evaluation.federated_precision(empty(f"{key}, det long, score double"), *args).count() == 0
