"""Small exact cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from geoledger.functions import boxes, classes, geometry, text
from geoledger.operators import evaluation, layers, overlay, raster, sampling, zonal
from geoledger.operators.graph import connected_components
from geoledger.streaming import progress


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_majority_of_map(spark):
    """Random counts against the rule: fine classes add up in their major class; the largest sum wins, ties to the smaller class."""
    rng = random.Random(12)
    majors = {k: spark.range(1).select(classes.major_class(F.lit(k)).alias("m")).first()["m"] for k in range(17)}
    maps = [None, {}] + [{rng.randrange(17): rng.choice([0, 3, 8, 8, 13]) for _ in range(rng.randrange(1, 9))} for _ in range(60)]
    want = []
    for counts in maps:
        sums = {m: sum(n for k, n in (counts or {}).items() if majors[k] == m) for m in range(1, 7)}
        want.append(min((-n, m) for m, n in sums.items())[1] if max(sums.values()) > 0 else 0)
    df = spark.createDataFrame(list(enumerate(maps)), "i int, m map<int,int>")
    assert [r[0] for r in df.orderBy("i").select(zonal.majority_of_map(F.col("m"))).collect()] == want and len(set(want)) > 4


def test_window_transform(spark):
    """The window's own first pixel lies where the whole's pixel (x, y) does; steps stay."""
    rng = random.Random(13)
    for _ in range(5):
        g, x, y = [rng.uniform(-50, 50) for _ in range(6)], rng.randrange(300), rng.randrange(300)
        found = one(spark, geometry.window_transform(F.array(*[F.lit(v) for v in g]), F.lit(x), F.lit(y)))
        assert found == pytest.approx([g[0] + x * g[1] + y * g[2], g[1], g[2], g[3] + x * g[4] + y * g[5], g[4], g[5]])


def test_mercator(spark):
    x, y = geometry.to_mercator(F.lit(1.0), F.lit(1.0))
    assert one(spark, x) == pytest.approx(111319.4908, abs=1e-4)
    assert one(spark, y) == pytest.approx(111325.1429, abs=1e-4)


def test_unit_box_overlaps(spark):
    other = [(0, 0, 1, 1), (0, 0, 0.5, 1), (0, 0, 1, 0.5), (0, 0, 0.5, 0.5), (0.5, 0.5, 1, 1), (0.5, 0.5, 1.5, 1.5)]
    df = spark.createDataFrame([tuple(map(float, b)) for b in other], "x0 double, y0 double, x1 double, y1 double")
    unit = tuple(F.lit(float(v)) for v in (0, 0, 1, 1))
    found = df.select(boxes.iou(unit, boxes.box()), boxes.ioa(unit, boxes.box())).collect()
    assert [r[0] for r in found] == pytest.approx([1, 0.5, 0.5, 0.25, 0.25, 0.25 / 1.75])
    assert [r[1] for r in found] == pytest.approx([1, 1, 1, 1, 1, 0.25])


def test_rotated_from_xywh(spark):
    b = tuple(F.lit(float(v)) for v in (30, 40, 70, 60))
    assert [one(spark, c) for c in boxes.rotated_from_xywh(b)] == [65, 70, 70, 60, 0]


def test_rounding_half_to_even(spark):
    assert one(spark, classes.binary_mask(F.lit(0.0))) == 0
    assert one(spark, classes.binary_mask(F.lit(0.1))) == 1


def test_wrong_boolean_is_an_error(spark):
    with pytest.raises(Exception, match="not a boolean"):
        one(spark, classes.as_bool(F.lit("maybe")))


def test_roi_with_hole(spark):
    rings = F.concat(geometry.rectangle(*map(F.lit, (0, 0, 10, 10))), geometry.rectangle(*map(F.lit, (4, 4, 6, 6))))
    cells = spark.range(100).select((F.col("id") % 10).alias("c"), F.floor(F.col("id") / 10).alias("r"))
    inside = cells.where(geometry.contains(rings, F.col("c") + 0.5, F.col("r") + 0.5))
    assert inside.count() == 96
    assert inside.where("c in (4, 5) and r in (4, 5)").count() == 0


def test_tiles_in_roi(spark):
    tiles = spark.createDataFrame([(0, 0, 0, 10, 10), (1, 20, 20, 30, 30)], "k int, x0 int, y0 int, x1 int, y1 int")
    roi = spark.createDataFrame([(0, 0, 10, 10)], "x0 int, y0 int, x1 int, y1 int")
    assert [r[0] for r in overlay.overlapping(tiles, roi).select("a.k").collect()] == [0]


def test_shards(spark):
    for n, parts, sizes in ((16, 2, [8, 8]), (2, 3, [1, 1]), (42, 4, [11, 11, 10, 10])):
        found = sampling.shards(spark.range(n).withColumn("g", F.lit(0)), "g", "id", parts).groupBy("shard").count().orderBy("shard").collect()
        assert [r["count"] for r in found] == sizes


def test_components_and_polygons_keep_area(spark):
    # A ring with a hole, and a cell in the hole.
    grid = ["#####", "#...#", "#.#.#", "#...#", "#####"]
    cells = spark.createDataFrame([(0, r, c, 1) for r, row in enumerate(grid) for c, x in enumerate(row) if x == "#"], "scene_id int, r int, c int, v int")
    labelled = raster.components(cells, 5)
    assert sorted((r[0], r[1]) for r in labelled.groupBy("label").count().collect()) == [(0, 16), (12, 1)]
    shapes = {r["label"]: r for r in layers.polygonize(labelled).withColumn("area", geometry.polygon_area(F.col("rings"))).collect()}
    assert shapes[0]["area"] == 16 and len(shapes[0]["rings"]) == 2
    assert shapes[12]["area"] == 1 and len(shapes[12]["rings"]) == 1


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(10, 40)] + [(50, 51), (51, 50), (7, 7), (60, 61)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {k: 10 for k in range(10, 41)} | {50: 50, 51: 50, 60: 60, 61: 60}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_greedy_matches(spark):
    rows = [(0, 1, 0.9, 100, 0.8), (0, 1, 0.9, 101, 0.6), (0, 2, 0.8, 100, 0.7), (0, 3, 0.7, None, None)]
    found = evaluation.greedy_matches(spark.createDataFrame(rows, "image long, det long, score double, truth long, iou double"), ["image"], "det", "truth", [0.5])
    assert {r["det"]: r["tp"] for r in found.collect()} == {1: 1, 2: 0, 3: 0}


def test_suppression(spark):
    rows = [(0, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (0, 1, 0.8, 1.0, 0.0, 11.0, 10.0), (0, 2, 0.7, 20.0, 0.0, 30.0, 10.0), (1, 3, 0.5, 0.0, 0.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "image int, id int, score double, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r["id"] for r in evaluation.suppressed(df, ["image"], "id", 0.5).collect()) == [0, 2, 3]


def test_log_time(spark):
    assert str(one(spark, text.log_time(F.lit("2026-05-18 10:11:12,345 - x")))) == "2026-05-18 10:11:12.345000"
    assert one(spark, text.log_time(F.lit("no time here"))) is None


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    live = progress.stream(spark, str(tmp_path / "in"))
    named = lambda df: df.select(F.col("user_id").alias("task"), F.col("event_id").alias("cur"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("file"), (F.col("value") % 100).alias("progress"))
    out = progress.throttled_stream(named(live), 2.0, 3.0).writeStream.format("memory").queryName("sent").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    out.awaitTermination(120)
    batch = progress.throttled(named(events), 2.0, 3.0)
    assert sorted(map(tuple, spark.table("sent").collect())) == sorted(map(tuple, batch.collect()))


def test_windows_on_a_stream(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(str(tmp_path / "in"))
    counts = progress.windowed_counts(progress.stream(spark, str(tmp_path / "in")), "1 day", "2 days")
    query = counts.writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    total = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == total


def test_assignment():
    import itertools

    import numpy as np

    from geoledger.operators.scoring import assigned

    rng = np.random.default_rng(0)
    for shape in ((3, 3), (2, 4), (4, 2), (5, 5)):
        cost = rng.random(shape)
        pairs = assigned(cost)
        small, large = min(shape), max(shape)
        best = min(sum(cost[(i, j) if shape[0] <= shape[1] else (j, i)] for i, j in enumerate(p)) for p in itertools.permutations(range(large), small))
        assert len(pairs) == small and sum(cost[i, j] for i, j in pairs) == pytest.approx(best)


def test_rotated_boxes():
    from geoledger.operators.scoring import rotated_iou

    assert rotated_iou((0, 0, 2, 2, 0), (0, 0, 2, 2, 90)) == pytest.approx(1)
    assert rotated_iou((0, 0, 2, 2, 0), (0, 0, 2, 2, 45)) == pytest.approx((8 * 2**0.5 - 8) / (8 - (8 * 2**0.5 - 8)))
    assert rotated_iou((0, 0, 1, 1, 0), (5, 5, 1, 1, 30)) == 0


def test_trackers(spark):
    from geoledger.operators.scoring import tracked

    rows = [(0, f, 10 * f + k, x + f * 0.5, 0.0, x + f * 0.5 + 10, 10.0) for f in range(4) for k, x in enumerate((0.0, 40.0)) if not (f == 2 and k == 1)]
    df = spark.createDataFrame(rows, "video long, frame long, box long, x0 double, y0 double, x1 double, y1 double")
    for method in ("iou", "assignment"):
        found = {r["box"]: r["track"] for r in tracked(df, "video", "frame", "box", method=method).collect()}
        assert found == {0: 0, 10: 0, 20: 0, 30: 0, 1: 1, 11: 1, 31: 1}
