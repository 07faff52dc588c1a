"""Readers: scene catalogs, vector and annotation files, logs and settings, as DataFrames. Paths are Spark's, so any store will do."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.functions.geometry import from_wkt
from geoledger.functions.text import stem
from geoledger.scratch import written
from geoledger.sources.elements import json_elements, json_records


def scene_catalog(spark: SparkSession, folder: str, glob: str = "*.{tif,tiff,img,IMG}") -> DataFrame:
    """(path, stem, size, mtime) of a folder's rasters; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", stem(F.col("path")).alias("stem"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def scene_list(spark: SparkSession, file: str, catalog: DataFrame) -> DataFrame:
    """The rows of a catalog whose names a text file lists, one a line."""
    names = spark.read.text(file).select(F.trim("value").alias("name")).where("name != ''").distinct()
    return catalog.join(names, F.element_at(F.split("path", "/"), -1) == F.element_at(F.split("name", "/"), -1), "left_semi")


def window(cells: DataFrame, x: int, y: int, width: int, height: int) -> DataFrame:
    """The cells of a window; on a table partitioned by tiles the range reaches the scan."""
    return cells.where(F.col("c").between(x, x + width - 1) & F.col("r").between(y, y + height - 1))


def swapped_bands(bands: list[str]) -> list[Column]:
    """Bands in the order 3, 2, 1 (4) where there are three or four of them."""
    return [F.col(b) for b in ([bands[2], bands[1], bands[0], *bands[3:]] if len(bands) in (3, 4) else bands)]


def vector_layer(features: DataFrame, geometry: str, crs: str = "crs") -> DataFrame:
    """``features`` after one pass that checks that each has a geometry and all one coordinate system."""
    row = features.agg(F.count("*").alias("n"), F.count_if(F.col(geometry).isNull()).alias("bare"), F.count_distinct(F.coalesce(crs, F.lit(""))).alias("systems")).first()
    if row["bare"] or row["systems"] > 1:
        raise ValueError(f"{row['bare']} of {row['n']} features have no geometry; {row['systems']} coordinate systems")
    return features


def boundaries(spark: SparkSession, file: str) -> DataFrame:
    """(ord, name, gb, rings) of a GeoJSON file's polygons with a name and a code, in source order; none is an error."""
    kind = "properties struct<name:string,gb:string>, geometry struct<type:string,coordinates:string>"
    raw = json_elements(spark, file, ["features"]).select("file", F.col("ord").cast("int").alias("ord"), F.from_json("value", kind).alias("f"))
    named = raw.where("coalesce(f.properties.name, '') != '' and coalesce(f.properties.gb, '') != '' and upper(f.geometry.type) like '%POLYGON%'")
    depth = F.when(F.upper("f.geometry.type") == "MULTIPOLYGON", F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")))
    rings = F.coalesce(depth, F.from_json("f.geometry.coordinates", "array<array<array<double>>>"))
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    # Elements come from a grouping, in no order.
    out = named.orderBy("file", "ord").select("ord", F.col("f.properties.name").alias("name"), F.col("f.properties.gb").alias("gb"), points.alias("rings"))
    if out.isEmpty():
        raise ValueError(f"no named polygons in {file}")
    return out


def region_of_interest(spark: SparkSession, wkt_file: str | None = None, layer: DataFrame | None = None) -> DataFrame | None:
    """Rings of a WKT file or of a layer; both is an error, neither means the whole image."""
    if wkt_file and layer is not None:
        raise ValueError("a region is given twice")
    if wkt_file:
        return spark.read.text(wkt_file, wholetext=True).select(from_wkt(F.col("value")).alias("rings"))
    return layer


def decoded(df: DataFrame, raw: str, encodings: tuple[str, ...] = ("utf-8", "gbk", "latin1")) -> DataFrame:
    """Bytes as text, by the first encoding that can read them. Spark itself knows a few encodings only."""

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        def one(value: bytes | None) -> str | None:
            for e in encodings if value is not None else ():
                try:
                    return bytes(value).decode(e)
                except UnicodeDecodeError:
                    continue
            return None

        return values.map(one)

    return df.withColumn(raw, text(raw))


def county_layer(layers: DataFrame, county: str) -> DataFrame:
    """A county's land use: its class column is the first one, whatever its name."""
    first = next(c for c in layers.columns if c != "county_id")
    return layers.where(F.col("county_id") == county).withColumn("land_use", F.col(first))


def catalog_items(responses: DataFrame, year: int, province: str) -> DataFrame:
    """Items of landed answers of a catalog service (a JSON text per page in ``value``), of a year and province."""
    kind = "result struct<item_list:array<struct<file_path:string,release_time:string,release_year:int,admin_province_code:string>>>"
    items = responses.select(F.explode(F.from_json("value", kind)["result"]["item_list"]).alias("i")).select("i.*")
    return items.where((F.col("release_year") == year) & (F.col("admin_province_code") == province)).withColumn("release_time", F.try_to_timestamp("release_time", F.lit("yyyy-MM-dd HH:mm:ss")))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text logs, by their place in each file; empty lines count, an end of line at the end adds none.

    Files are read in splits. A line's number is its place in its split and the number of lines in the splits before, so
    that only one row a split is ordered. The lines are written once, as a log may grow while it is read.
    """
    # A split is read in order, by one task.
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    lines = written(read, "lines")
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = splits.select("file", "start", (before - F.col("first") + 1).alias("offset"))
    return lines.join(offsets, ["file", "start"]).select("file", (F.col("at") + F.col("offset")).alias("line_no"), "value")


def settings(texts: DataFrame, schema: str) -> DataFrame:
    """The fields of a settings object's ``config``; a text that isn't such an object is an error."""
    return texts.select(F.from_json("value", f"config struct<{schema}>", {"mode": "FAILFAST"})["config"].alias("config")).select("config.*")


def numbers(spark: SparkSession, file: str, kind: str = "double") -> DataFrame:
    """(at, value): one number a line; ``at`` counts lines from 0, empty ones too, which give no row."""
    return log_lines(spark, file).where("trim(value) != ''").select((F.col("line_no") - 1).alias("at"), F.trim("value").cast(kind).alias("value"))


def colour_table(spark: SparkSession, file: str) -> DataFrame:
    """(at, red, green, blue) of lines ``r/g/b#comment``."""
    parts = F.split(F.substring_index("value", "#", 1), "/")
    return log_lines(spark, file).where("trim(value) != ''").select((F.col("line_no") - 1).alias("at"), *[F.trim(parts[i]).cast("int").alias(n) for i, n in enumerate(("red", "green", "blue"))])


_IMAGES = "id bigint, file_name string, height int, width int, neg_category_ids array<int>, not_exhaustive_category_ids array<int>"
_ANNOTATIONS = "id bigint, image_id bigint, category_id int, bbox array<double>, iscrowd int, segmentation array<array<double>>, keypoints array<double>"


def coco(spark: SparkSession, file: str, shift: int | None = None) -> DataFrame:
    """One record per image with its annotations nested, category ids from 0 on.

    Polygons of fewer than six numbers go, and annotations that had polygons and keep none. Keypoints move by half a pixel.
    Annotation ids that repeat are an error. ``shift`` subtracts a number from the ids in place of ranking them. Files are
    read in splits, element by element; one may hold several objects, and there may be several files. Only the ids of the
    categories come to the driver.
    """
    # Each element is parsed once; what follows reads columns.
    kinds = {"images": _IMAGES, "annotations": _ANNOTATIONS, "categories": "id int"}
    raw = written(json_records(spark, file, kinds).select("field", *kinds), "elements")
    of = lambda k: raw.where(F.col("field") == k).select(f"{k}.*")
    anns = of("annotations")
    ids = anns.agg(F.count("id").alias("n"), F.count_distinct("id").alias("d")).first()
    if ids["n"] != ids["d"]:
        raise ValueError("annotation ids repeat")
    kept = F.filter("segmentation", lambda p: (F.size(p) % 2 == 0) & (F.size(p) >= 6))
    had = F.coalesce(F.size("segmentation") > 0, F.lit(False))
    anns = anns.withColumn("_had", had).withColumn("segmentation", kept).where("not _had or size(segmentation) > 0").drop("_had")
    anns = anns.withColumn("keypoints", F.transform("keypoints", lambda v, i: F.when(i % 3 != 2, v + 0.5).otherwise(v)))
    if shift is None:
        order = of("categories").where("id is not null").distinct().orderBy("id").collect()
        known = F.array(*[F.lit(r["id"]) for r in order]).cast("array<int>")
        anns = anns.withColumn("category_id", F.array_position(known, F.col("category_id")).cast("int") - 1)
    else:
        anns = anns.withColumn("category_id", F.col("category_id") - shift)
    images = of("images")
    held = anns.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("id", "category_id", "bbox", "iscrowd", "segmentation", "keypoints"))).alias("annotations"))
    return images.join(held, images["id"] == held["image_id"], "left").drop("image_id").withColumnRenamed("id", "image_id")


def lvis(spark: SparkSession, file: str) -> DataFrame:
    """The same for files with negative and not exhaustive categories; their ids are counted from 1."""
    return coco(spark, file, shift=1)


def pascal_voc(spark: SparkSession, folder: str, names: list[str], lines: bool = False) -> DataFrame:
    """(file_name, width, height, category_id, x0, y0, x1, y1, difficult): one row per object; the first pixel is 0.

    A file is one document, or with ``lines`` each of its lines is one, so that files are read in splits.
    """
    kind = "filename string, size struct<width:int,height:int>, object array<struct<name:string,difficult:int,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"
    raw = spark.read.format("xml").option("rowTag", "annotation").option("multiLine", not lines).schema(kind).load(folder)
    each = raw.select(F.col("filename").alias("file_name"), "size.width", "size.height", F.explode("object").alias("o"))
    known = F.array(*[F.lit(n) for n in names])
    box = F.col("o.bndbox")
    return each.select("file_name", "width", "height", (F.array_position(known, F.col("o.name")).cast("int") - 1).alias("category_id"), (box["xmin"] - 1).alias("x0"), (box["ymin"] - 1).alias("y0"), box["xmax"].alias("x1"), box["ymax"].alias("y1"), F.coalesce(F.col("o.difficult"), F.lit(0)).alias("difficult"))


def panoptic(spark: SparkSession, file: str, things: dict[int, int], stuff: dict[int, int]) -> DataFrame:
    """(image_id, segment_id, category_id, isthing): segments under their contiguous ids; unknown categories are an error downstream (null)."""
    kind = "image_id bigint, segments_info array<struct<id:bigint,category_id:int>>"
    each = json_records(spark, file, {"annotations": kind}).select("annotations.image_id", F.explode("annotations.segments_info").alias("s"))
    look = lambda m: F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("s.category_id")) if m else F.lit(None).cast("int")
    return each.select("image_id", F.col("s.id").alias("segment_id"), F.coalesce(look(things), look(stuff)).alias("category_id"), look(things).isNotNull().alias("isthing"))


def paired_files(images: DataFrame, labels: DataFrame, pattern: str) -> DataFrame:
    """(key, image, label): files of two listings whose paths give the same key by a regular expression's first group."""
    key = lambda df, name: df.select(F.regexp_extract("path", pattern, 1).alias("key"), F.col("path").alias(name)).where("key != ''")
    return key(images, "image").join(key(labels, "label"), "key")


def cityscapes(spark: SparkSession, images: str, truth: str) -> DataFrame:
    """(city, key, image, instances, labels, shapes): each image of a folder by city with its files of truth, null for one that isn't there."""

    def listed(folder: str, end: str, name: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{end}").option("recursiveFileLookup", "true").load(folder)
        part = lambda i: F.regexp_extract("path", rf"([^/]+)/([^/]+)\Q{end}\E$", i)
        return files.select(part(1).alias("city"), part(2).alias("key"), F.col("path").alias(name))

    out = listed(images, "_leftImg8bit.png", "image")
    for end, name in (("instanceIds.png", "instances"), ("labelIds.png", "labels"), ("polygons.json", "shapes")):
        out = out.join(listed(truth, f"_gtFine_{end}", name), ["city", "key"], "left")
    return out


def cityscapes_shapes(spark: SparkSession, truth: str) -> DataFrame:
    """(path, ord, label, crowd, ring): the polygons of the files of truth in their order; a name that ends in ``group`` stands for a crowd."""
    kind = "objects array<struct<label:string,deleted:int,polygon:array<array<double>>>>"
    read = spark.read.option("multiLine", True).option("pathGlobFilter", "*_polygons.json").option("recursiveFileLookup", "true").schema(kind).json(truth)
    each = read.select(F.col("_metadata.file_path").alias("path"), F.posexplode("objects").alias("ord", "o")).where("coalesce(o.deleted, 0) = 0")
    ring = F.transform("o.polygon", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return each.select("path", "ord", F.regexp_replace("o.label", "group$", "").alias("label"), F.col("o.label").endswith("group").alias("crowd"), ring.alias("ring"))


def with_proposals(records: DataFrame, proposals: DataFrame) -> DataFrame:
    """Records by image id, as text, with their proposals (boxes, logits) by falling logit."""
    sorted_ = F.sort_array(F.arrays_zip(F.col("logits").alias("score"), F.col("boxes").alias("box")), asc=False)
    lists = proposals.select(F.col("ids").cast("string").alias("_id"), sorted_.alias("proposals"))
    return records.join(lists, records["image_id"].cast("string") == lists["_id"]).drop("_id")
