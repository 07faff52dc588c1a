from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from geoledger.functions.geometry import polygon_area, rectangle
from geoledger.sources import readers, writers


def test_catalog_and_list(spark, tmp_path):
    for name in ("A_1.tif", "B_2.tiff", "c.txt"):
        (tmp_path / name).write_text("x")
    (tmp_path / "list.txt").write_text("A_1.tif\n\n")
    catalog = readers.scene_catalog(spark, str(tmp_path))
    assert sorted(r["stem"] for r in catalog.collect()) == ["A_1", "B_2"]
    assert [r["stem"] for r in readers.scene_list(spark, str(tmp_path / "list.txt"), catalog).collect()] == ["A_1"]


def test_boundaries(spark, tmp_path):
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    feature = lambda name, kind, c: {"properties": {"name": name, "gb": "1"}, "geometry": {"type": kind, "coordinates": c}}
    file = tmp_path / "b.json"
    file.write_text(json.dumps({"features": [feature("", "Polygon", square), feature("P", "Polygon", square), feature("M", "MultiPolygon", [square]), feature("L", "LineString", square[0])]}))
    found = readers.boundaries(spark, str(file)).select("name", polygon_area(F.col("rings")).alias("a")).collect()
    assert [(r["name"], r["a"]) for r in found] == [("P", 4.0), ("M", 4.0)]


def test_region(spark, tmp_path):
    file = tmp_path / "roi.wkt"
    file.write_text("POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")
    roi = readers.region_of_interest(spark, str(file))
    assert roi.select(polygon_area(F.col("rings"))).first()[0] == 96
    with pytest.raises(ValueError, match="twice"):
        readers.region_of_interest(spark, str(file), roi)


def test_encodings(spark):
    df = spark.createDataFrame([(t,) for t in ("café".encode(), "省份".encode("gbk"))], "t binary")
    assert [r["t"] for r in readers.decoded(df, "t").collect()] == ["café", "省份"]


def test_coco(spark, tmp_path):
    file = tmp_path / "c.json"
    anns = [{"id": 1, "image_id": 7, "category_id": 5, "bbox": [0, 0, 1, 1], "iscrowd": 0, "segmentation": [[0, 0, 1, 0, 1, 1], [0, 0]], "keypoints": [1, 2, 2]}, {"id": 2, "image_id": 7, "category_id": 9, "segmentation": [[1, 2]]}]
    file.write_text(json.dumps({"images": [{"id": 7, "file_name": "a", "height": 4, "width": 4}, {"id": 8, "file_name": "b", "height": 4, "width": 4}], "annotations": anns, "categories": [{"id": 9, "name": "y"}, {"id": 5, "name": "x"}]}))
    rows = {r["image_id"]: r for r in readers.coco(spark, str(file)).collect()}
    assert rows[8]["annotations"] is None
    (ann,) = rows[7]["annotations"]
    assert ann["category_id"] == 0 and ann["segmentation"] == [[0, 0, 1, 0, 1, 1]] and ann["keypoints"] == [1.5, 2.5, 2]


def test_voc(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<annotation><filename>a.jpg</filename><size><width>9</width><height>8</height></size><object><name>dog</name><difficult>1</difficult><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>5</xmax><ymax>6</ymax></bndbox></object></annotation>")
    (row,) = readers.pascal_voc(spark, str(tmp_path), ["cat", "dog"]).collect()
    assert tuple(row) == ("a.jpg", 9, 8, 1, 0.0, 1.0, 5.0, 6.0, 1)


def test_tables_of_numbers(spark, tmp_path):
    (tmp_path / "n").write_text("0.5\n1.5\n")
    (tmp_path / "c").write_text("1/2/3#first\n4/5/6\n")
    assert [tuple(r) for r in readers.numbers(spark, str(tmp_path / "n")).orderBy("at").collect()] == [(0, 0.5), (1, 1.5)]
    assert [tuple(r)[1:] for r in readers.colour_table(spark, str(tmp_path / "c")).orderBy("at").collect()] == [(1, 2, 3), (4, 5, 6)]


def test_lines_of_files_in_many_splits(spark, tmp_path):
    """Numbers count on over the splits of a file, whatever the ends of lines, and start anew with each file."""
    rng = random.Random(5)
    lines = {f"{k}.log": ["é" * rng.randrange(90) if rng.random() < 0.8 else "" for _ in range(400)] for k in range(3)}
    lines["one.log"], lines["none.log"] = ["x" * 3000], []
    for k, (name, own) in enumerate(lines.items()):
        (tmp_path / name).write_bytes(("\r\n" if k == 1 else "\n").join(own).encode() + b"\n" * bool(own and k != 2))
    if not lines["2.log"][-1]:
        lines["2.log"].pop()  # an empty line without an end is none
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        found = readers.log_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    got: dict[str, list] = {name: [] for name in lines}
    for r in sorted(found, key=lambda r: r["line_no"]):
        got[r["file"].rsplit("/", 1)[1]].append((r["line_no"], r["value"]))
    assert got == {name: list(enumerate(own, 1)) for name, own in lines.items()}


def test_settings_must_be_an_object(spark):
    assert readers.settings(spark.createDataFrame([('{"config": {"n": 4}}',)], "value string"), "n int").first()["n"] == 4
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        readers.settings(spark.createDataFrame([("[1",)], "value string"), "n int").collect()


def test_writers(spark, tmp_path):
    writers.final_layer(spark.createDataFrame([], writers.FINAL), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).columns == ["uid", "pre_code", "pre_name", "curr_code", "curr_name", "province", "geometry"]
    cells = spark.createDataFrame([(0, 0, 0, 0), (0, 600, 1, 3)], "scene_id int, r int, c int, v int")
    writers.class_raster(cells, str(tmp_path / "r"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).select("tile_row", "r", "v").collect()] == [(1, 600, 3)]
    shape = spark.range(1).select(rectangle(*map(F.lit, (0, 0, 1, 1))).alias("rings"), F.lit(7).alias("code"))
    assert json.loads(writers.geojson_lines(shape, "rings", ["code"]).first()[0])["geometry"]["coordinates"][0][2] == [1.0, 1.0]
    blocks = writers.tile_manifest(spark.createDataFrame([("s", 0.0, 100.0, 2.0, 50, 30)], "scene string, left double, top double, res double, width int, height int"), 20)
    assert {r["id"]: r["x1"] for r in blocks.collect()} == {"0_0": 40.0, "0_1": 80.0, "0_2": 100.0, "1_0": 40.0, "1_1": 80.0, "1_2": 100.0}
