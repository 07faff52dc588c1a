"""Centre lines against a plain version, their graph on drawn figures, and hooks for a user's functions."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from geoledger.functions.geometry import rectangle
from geoledger.operators import hooks, lines
from geoledger.sources import readers

CELLS = "scene_id long, r long, c long"


def plain_thinned(cells: set) -> set:
    """One cell after the other, both turns, until nothing goes."""
    while True:
        before = set(cells)
        for turn in (0, 1):
            gone = set()
            for r, c in cells:
                p = [(r + dy, c + dx) in cells for dy, dx in lines.AROUND]
                corners = sum(not p[k] and (p[k + 1] or p[(k + 2) % 8]) for k in (0, 2, 4, 6))
                n1 = sum(p[k - 1] or p[k] for k in (0, 2, 4, 6))
                n2 = sum(p[k] or p[k + 1] for k in (0, 2, 4, 6))
                kept = (p[4] or p[5] or not p[7]) and p[6] if turn == 0 else (p[0] or p[1] or not p[3]) and p[2]
                if corners == 1 and 2 <= min(n1, n2) <= 3 and not kept:
                    gone.add((r, c))
            cells = cells - gone
        if cells == before:
            return cells


def parts(cells: set) -> int:
    left, n = set(cells), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            r, c = todo.pop()
            for q in ((r + dy, c + dx) for dy, dx in lines.AROUND):
                if q in left:
                    left.remove(q)
                    todo.append(q)
    return n


def drawn(text: str) -> set:
    return {(r, c) for r, row in enumerate(text.split()) for c, v in enumerate(row) if v == "#"}


@pytest.fixture(scope="module")
def scenes() -> list[set]:
    rng = random.Random(5)
    noise = {(r, c) for r in range(24) for c in range(24) if rng.random() < 0.6}
    return [noise, {(r, c) for r in range(7) for c in range(20)}, {(3, 3), (3, 4), (4, 3), (4, 4)}, {(9, 9)}]


def test_thinned(spark, scenes):
    rows = [(s, r, c) for s, cells in enumerate(scenes) for r, c in cells]
    found = lines.thinned(spark.createDataFrame([*rows, rows[0], (0, None, 1)], CELLS)).collect()
    for s, cells in enumerate(scenes):
        thin = {(r["r"], r["c"]) for r in found if r["scene_id"] == s}
        assert thin == plain_thinned(cells)
        assert parts(thin) == parts(cells)


def test_thinned_empty(spark):
    empty = spark.createDataFrame([], CELLS)
    vertices, edges, members = lines.line_graph(lines.thinned(empty))
    assert vertices.count() == edges.count() == members.count() == lines.lines_of(edges, members, 1.0).count() == 0


def test_graph(spark):
    figures = [
        "......#...... ......#...... ......#...... #############",  # three arms
        ".###. #...# #...# #...# .###.",  # a ring
        "####",
        "#",
    ]
    rows = [(s, r, c) for s, text in enumerate(figures) for r, c in drawn(text)]
    vertices, edges, members = lines.line_graph(spark.createDataFrame(rows, CELLS))
    ends = {(r["scene_id"], r["r"], r["c"]) for r in vertices.where("degree < 2").collect()}
    assert ends == {(0, 0, 6), (0, 3, 0), (0, 3, 12), (2, 0, 0), (2, 0, 3), (3, 0, 0)}
    assert [tuple(r) for r in edges.where("scene_id = 2").select("a", "b", "cells").collect()] == [(2 << 40, (2 << 40) + 3, 2)]
    ring = edges.where("scene_id = 1").collect()
    assert [(r["a"], r["b"], r["cells"]) for r in ring] == [(None, None, 12)]
    shapes = {r["scene_id"]: r["points"] for r in lines.lines_of(edges, members, 0.9).where("scene_id in (1, 2)").collect()}
    assert [(p["x"], p["y"]) for p in shapes[2]] == [(0.5, 0.5), (3.5, 0.5)]
    assert shapes[1][0] == shapes[1][-1] and len(shapes[1]) >= 4
    assert edges.where("scene_id = 0 and cells > 0").count() == 3


def test_polygon_cells(spark):
    x = [F.lit(v) for v in (1, 2, 5, 6)]
    holed = F.concat(rectangle(*x), rectangle(*[F.lit(v) for v in (2, 3, 3, 4)]))
    shapes = spark.range(1).select(F.lit(7).alias("fid"), holed.alias("rings")).unionByName(spark.range(1).select(F.lit(8).alias("fid"), F.lit(None).cast("array<array<struct<x:int,y:int>>>").alias("rings")), allowMissingColumns=True)
    found = {tuple(r) for r in hooks.polygon_cells(shapes, "rings", ["fid"]).collect()}
    assert found == {(7, r, c) for r in range(2, 6) for c in range(1, 5)} - {(7, 3, 2)}


def test_labels_of_own_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("12\n03")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = hooks.loaded_labels(files, lambda b: [[int(v) for v in row] for row in b.decode().split("\n")]).drop("path").collect()
    assert sorted(tuple(r) for r in found) == [(0, 0, 1), (0, 1, 2), (1, 0, 0), (1, 1, 3)]


def test_finished_keeps_the_raw_layer(spark):
    raw = spark.range(3)
    assert hooks.finished(raw, lambda df: df.where("id > 0"), None).count() == 2
    assert raw.count() == 3


def test_cityscapes(spark, tmp_path):
    for city, key, truth in (("ulm", "ulm_1", True), ("bonn", "bonn_4", False)):
        (tmp_path / "img" / city).mkdir(parents=True)
        (tmp_path / "gt" / city).mkdir(parents=True)
        (tmp_path / "img" / city / f"{key}_leftImg8bit.png").write_text("x")
        if truth:
            for end in ("instanceIds.png", "labelIds.png"):
                (tmp_path / "gt" / city / f"{key}_gtFine_{end}").write_text("x")
            shapes = [{"label": "cargroup", "polygon": [[0, 0], [4, 0], [4, 3]]}, {"label": "sky", "deleted": 1, "polygon": []}]
            (tmp_path / "gt" / city / f"{key}_gtFine_polygons.json").write_text(json.dumps({"objects": shapes}))
    found = {r["key"]: r for r in readers.cityscapes(spark, str(tmp_path / "img"), str(tmp_path / "gt")).collect()}
    assert found["ulm_1"]["city"] == "ulm" and found["ulm_1"]["labels"].endswith("ulm_1_gtFine_labelIds.png")
    assert found["bonn_4"]["shapes"] is None
    shape = readers.cityscapes_shapes(spark, str(tmp_path / "gt")).collect()
    assert [(r["label"], r["crowd"], len(r["ring"])) for r in shape] == [("car", True, 3)]
