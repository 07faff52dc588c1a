"""Matches and scores with one row a detection against those with a row for each threshold, range and limit."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from geoledger.operators import evaluation

AREAS = {"all": (0, 1e10), "small": (0, 30), "large": (30, 1e10)}
LIMITS = {"all": [1, 3, 100], "small": [100], "large": [100]}
THRESHOLDS = [0.5, 0.6, 0.75]


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(6)
    rows = []
    for d in range(1 << 60, (1 << 60) + 400):
        image, cat, score, size = rng.randrange(25), rng.randrange(3), rng.randrange(40) / 20 - 0.5, float(rng.randrange(60))
        truths = rng.sample(range(4), rng.randrange(4))
        rows += [(image, cat, d, score, size, image * 100 + cat * 10 + t, float((image * 7 + t * 13) % 60), rng.randrange(30, 100) / 100) for t in truths] or [(image, cat, d, score, size, None, None, None)]
    return spark.createDataFrame(rows, "image long, cat long, det long, score double, det_size double, truth long, truth_size double, iou double")


def test_levels_against_rows(spark, pairs):
    keys = ["image", "cat"]
    rows = evaluation.greedy_matches(pairs, keys, "det", "truth", THRESHOLDS, AREAS)
    levels = evaluation.greedy_levels(pairs, keys, "det", "truth", THRESHOLDS, AREAS)
    assert levels.count() == pairs.select("det").distinct().count()
    want = {(r["det"], r["area"], r["threshold"]): (r["place"], r["tp"]) for r in rows.collect()}
    bits = [(a, t) for a in AREAS for t in THRESHOLDS]
    got = {(r["det"], *bit): (r["place"], r["hits"] >> i & 1) for r in levels.collect() for i, bit in enumerate(bits) if r["counts"] >> i & 1}
    assert got == want and {v[1] for v in want.values()} == {0, 1}

    counts = spark.createDataFrame([(c, a, n) for c in (0, 1, 2, 9) for a, n in (("all", 90), ("small", 50), ("large", 40))], "cat long, area string, truths long").where("cat <> 2 or area <> 'small'")
    name = lambda df: {tuple(r[:4]): (round(r["ap"], 9), r["ar"]) for r in df.collect()}
    plain = name(evaluation.coco_precision(rows, counts, "cat", "det", THRESHOLDS, LIMITS))
    assert name(evaluation.coco_precision_of_levels(levels, counts, "cat", "det", THRESHOLDS, LIMITS)) == plain
    assert len(plain) == 57 and sum(v[0] > 0 for v in plain.values()) > 30 and plain[9, "all", 1, 0.5] == (0.0, 0.0)


def test_slices_over_several_batches(spark, pairs):
    """A slice's counts go on from batch to batch."""
    levels = evaluation.greedy_levels(pairs.withColumn("score", F.lit(0.5)), ["image", "cat"], "det", "truth", [0.5])
    rows = evaluation.greedy_matches(pairs.withColumn("score", F.lit(0.5)), ["image", "cat"], "det", "truth", [0.5])
    counts = spark.createDataFrame([(0, "all", 90), (1, "all", 80)], "cat long, area string, truths long")
    name = lambda df: {r["cat"]: (round(r["ap"], 9), r["ar"]) for r in df.collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = name(evaluation.coco_precision_of_levels(levels, counts, "cat", "det", [0.5], {"all": [100]}))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == name(evaluation.coco_precision(rows, counts, "cat", "det", [0.5], {"all": [100]}))


def test_too_many_levels(pairs):
    with pytest.raises(ValueError, match="63"):
        evaluation.greedy_levels(pairs, ["image", "cat"], "det", "truth", [k / 100 for k in range(64)])
