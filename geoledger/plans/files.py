"""Queries over what readers take in and writers give out: files, envelopes, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions import geometry
from geoledger.operators import runs
from geoledger.plans.catalog import query
from geoledger.scratch import shared_folder
from geoledger.sources import readers, writers


def _path(df: DataFrame, name: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


@query("a3_raster_window", "v_cells", sql="select scene_id, r, c, post_class as first, pre_class as third from v_cells where c between 8 and 39 and r between 16 and 31")
def raster_window(cells: DataFrame) -> DataFrame:
    """A window of every scene, with its bands in swapped order."""
    bands = cells.select("scene_id", "r", "c", F.col("pre_class").alias("b1"), F.lit(0).alias("b2"), F.col("post_class").alias("b3"))
    first, _, third = readers.swapped_bands(["b1", "b2", "b3"])
    return readers.window(bands, 8, 16, 32, 16).select("scene_id", "r", "c", first.alias("first"), third.alias("third"))


@query("a4_vector_layer", "v_polygons", sql="select fid, cast((x1 - x0) * (y1 - y0) as double) as area from v_polygons")
def vector_layer(polygons: DataFrame) -> DataFrame:
    shaped = polygons.select("fid", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"), F.lit("EPSG:4326").alias("crs"))
    return readers.vector_layer(shaped, "rings").select("fid", geometry.polygon_area(F.col("rings")).alias("area"))


@query("a1_scene_catalog", "orders", sql="select substr(o_orderpriority, 1, 1) as folder, cast(sum(length(cast(o_orderkey as varchar)) + 1) as bigint) as bytes, true as named from orders group by all")
def scene_catalog(orders: DataFrame) -> DataFrame:
    """Files of keys by priority, listed with their sizes."""
    path = _path(orders, "scenes")
    orders.select(F.substring("o_orderpriority", 1, 1).alias("p"), F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("p").text(path)
    listed = readers.scene_catalog(orders.sparkSession, path, glob="*.txt")
    return listed.groupBy(F.regexp_extract("path", "/p=(.)/", 1).alias("folder")).agg(F.sum("size").alias("bytes"), F.every(F.col("stem").startswith("part-")).alias("named"))


@query("a2_scene_list", "orders", sql="select cast(sum(length(cast(o_orderkey as varchar)) + 1) as bigint) as bytes from orders where o_custkey % 2 = 0")
def scene_list(orders: DataFrame) -> DataFrame:
    """Two folders of files, of which a list names those of the first."""
    spark, path = orders.sparkSession, _path(orders, "scenes")
    keys = lambda k: orders.where(f"o_custkey % 2 = {k}").select(F.col("o_orderkey").cast("string").alias("value"))
    for k, name in enumerate(("first", "second")):
        keys(k).write.text(f"{path}/all/{name}")
    readers.scene_catalog(spark, f"{path}/all/first", glob="*.txt").select(F.concat(F.lit(" old/"), F.element_at(F.split("path", "/"), -1))).write.text(f"{path}/list")
    return readers.scene_list(spark, f"{path}/list", readers.scene_catalog(spark, f"{path}/all", glob="*.txt")).agg(F.sum("size").alias("bytes"))


@query("a5_boundaries", "v_polygons", sql="""with n as (select *, row_number() over (partition by scene_id order by fid) - 1 as ord from v_polygons)
select cast(ord as int) as ord, concat('P', cast(fid as varchar)) as name, cast(fid as varchar) as gb, cast((x1 - x0) * (y1 - y0) as double) as area from n where fid % 10 <> 0""")
def boundaries(polygons: DataFrame) -> DataFrame:
    """A collection of features for each scene, written as JSON; every tenth has no code."""
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    ring = F.array(F.array(*[F.array(F.col(x), F.col(y)) for x, y in corners]))
    code = F.when(F.col("fid") % 10 != 0, F.col("fid").cast("string"))
    feature = F.struct(F.struct(F.concat(F.lit("P"), F.col("fid").cast("string")).alias("name"), code.alias("gb")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"))
    listed = polygons.groupBy("scene_id").agg(F.sort_array(F.collect_list(F.struct("fid", feature.alias("feature")))).alias("f"))
    path = _path(polygons, "boundaries")
    listed.select(F.to_json(F.struct(F.col("f.feature").alias("features"))).alias("value")).write.text(path)
    return readers.boundaries(polygons.sparkSession, path).select("ord", "name", "gb", geometry.polygon_area(F.col("rings")).alias("area"))


@query("a14_lvis_records", "v_anns", sql="select image_id, count(*) as n, cast(sum(category_id) as bigint) as categories, cast(image_id % 80 as int) as absent from v_anns group by image_id")
def lvis_records(anns: DataFrame) -> DataFrame:
    """Written as JSON, and read back in splits; each image has a category that isn't there."""
    ann = F.struct((F.col("category_id") + 1).alias("category_id"), "iscrowd")
    image = F.struct(F.col("image_id").alias("id"), F.array((F.col("image_id") % 80).cast("int")).alias("neg_category_ids"))
    path = _path(anns, "lvis")
    # Line numbers repeat within an order; an id is an image's and the place in its list.
    numbered = F.transform(F.collect_list(ann), lambda a, i: F.struct(F.col("image_id"), a["category_id"].alias("category_id"), a["iscrowd"].alias("iscrowd"), (F.col("image_id") * 1000 + i).alias("id")))
    anns.groupBy("image_id").agg(numbered.alias("annotations")).select(F.to_json(F.struct(F.array(image).alias("images"), "annotations")).alias("value")).write.text(path)
    total = F.aggregate("annotations", F.lit(0).cast("long"), lambda s, a: s + a["category_id"])
    read = readers.lvis(anns.sparkSession, path)
    return read.select("image_id", F.size("annotations").cast("long").alias("n"), total.alias("categories"), F.col("neg_category_ids")[0].alias("absent"))


@query("a15_voc_objects", "v_boxes", sql="select concat(cast(image_id as varchar), '.jpg') as file_name, 300 as width, 200 as height, cast(category_id as int) as category_id, x0, y0, x1, y1, case when box_id % 7 = 0 then 1 else 0 end as difficult from v_boxes where is_gt = 1")
def voc_objects(boxes: DataFrame) -> DataFrame:
    """Truths as an XML document for each image."""
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    corner = lambda name, value: tag(name, value.cast("string"))
    box = F.concat(corner("xmin", F.col("x0") + 1), corner("ymin", F.col("y0") + 1), corner("xmax", F.col("x1")), corner("ymax", F.col("y1")))
    each = tag("object", F.concat(tag("name", F.concat(F.lit("n"), F.col("category_id").cast("string"))), tag("difficult", (F.col("box_id") % 7 == 0).cast("int").cast("string")), tag("bndbox", box)))
    docs = boxes.where("is_gt = 1").groupBy("image_id").agg(F.array_join(F.collect_list(each), "").alias("objects"))
    size = F.lit("<size><width>300</width><height>200</height></size>")
    path = _path(boxes, "voc")
    docs.select(tag("annotation", F.concat(tag("filename", F.concat(F.col("image_id").cast("string"), F.lit(".jpg"))), size, F.col("objects")))).write.text(path)
    return readers.pascal_voc(boxes.sparkSession, path, [f"n{k}" for k in range(5)], lines=True)


@query("a16_panoptic_segments", "v_anns", sql="""select image_id, cast(ann_no as bigint) as segment_id, case when category_id = 79 then null when category_id % 2 = 0 then category_id // 2 else 40 + category_id // 2 end as category_id, category_id % 2 = 0 as isthing from v_anns""")
def panoptic_segments(anns: DataFrame) -> DataFrame:
    """Even categories are things, odd ones stuff; the last is not known."""
    segments = F.collect_list(F.struct(F.col("ann_no").alias("id"), "category_id")).alias("segments_info")
    path = _path(anns, "panoptic")
    anns.groupBy("image_id").agg(segments).select(F.to_json(F.struct(F.array(F.struct("image_id", "segments_info")).alias("annotations"))).alias("value")).write.text(path)
    return readers.panoptic(anns.sparkSession, path, {k: k // 2 for k in range(0, 80, 2)}, {k: 40 + k // 2 for k in range(1, 79, 2)})


@query("b2_final_layer", "v_polygons", sql="select fid as uid, cast(x0 as int) as pre_code, concat('p', cast(x0 as varchar)) as pre_name, cast(y0 as int) as curr_code, 'c' as curr_name, cast(null as varchar) as province, concat('g', cast(fid as varchar)) as geometry from v_polygons")
def final_layer(polygons: DataFrame) -> DataFrame:
    """Written with its seven columns, and read back; other columns aren't written."""
    path = _path(polygons, "final")
    named = polygons.select(F.col("fid").alias("uid"), F.col("x0").cast("int").alias("pre_code"), F.concat(F.lit("p"), F.col("x0").cast("string")).alias("pre_name"), F.col("y0").cast("int").alias("curr_code"), F.lit("c").alias("curr_name"), F.lit(None).cast("string").alias("province"), F.concat(F.lit("g"), F.col("fid").cast("string")).alias("geometry"), "scene_id")
    writers.final_layer(named, path)
    return polygons.sparkSession.read.parquet(path)


@query("a7_decoded_names", "customer", sql="select c_custkey, concat(c_name, case when c_custkey % 2 = 0 then ' café' else ' 省份' end) as name from customer")
def decoded_names(customer: DataFrame) -> DataFrame:
    """Names as bytes of UTF-8 and of GBK."""
    text = F.when(F.col("c_custkey") % 2 == 0, F.encode(F.concat("c_name", F.lit(" café")), "UTF-8")).otherwise(F.concat(F.col("c_name").cast("binary"), F.unhex(F.lit("20" + "省份".encode("gbk").hex()))))
    return readers.decoded(customer.select("c_custkey", text.alias("name")), "name")


@query("a8_county_layer", "v_provinces", sql="select name, ord as land_use from v_provinces where ord % 5 = 2")
def county_layer(provinces: DataFrame) -> DataFrame:
    layers = provinces.select((F.col("ord") % 5).cast("string").alias("county_id"), F.col("ord").alias("lu_2021"), "name")
    return readers.county_layer(layers, "2").select("name", "land_use")


@query("a9_catalog_items", "orders", sql="""select concat('/d', cast(o_orderkey as varchar)) as file_path, cast(o_orderdate as timestamp) as release_time from orders
 where extract(year from o_orderdate) = 1995 and o_custkey % 30 = 7""")
def catalog_items(orders: DataFrame) -> DataFrame:
    """Answers of one item each, as JSON texts."""
    item = F.struct(F.concat(F.lit("/d"), F.col("o_orderkey").cast("string")).alias("file_path"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("release_time"), F.year("o_orderdate").alias("release_year"), (F.col("o_custkey") % 30).cast("string").alias("admin_province_code"))
    answers = orders.select(F.to_json(F.struct(F.struct(F.array(item).alias("item_list")).alias("result"))).alias("value"))
    return readers.catalog_items(answers, 1995, "7").select("file_path", F.col("release_time").cast("timestamp_ntz").alias("release_time"))


@query("a11_settings", "orders", sql="select o_orderkey % 9 as batch, count(*) as n, min(o_orderstatus) as least from orders group by all")
def settings(orders: DataFrame) -> DataFrame:
    texts = orders.select(F.to_json(F.struct(F.struct((F.col("o_orderkey") % 9).alias("batch"), F.col("o_orderstatus").alias("mode")).alias("config"))).alias("value"))
    return readers.settings(texts, "batch bigint, mode string").groupBy("batch").agg(F.count("*").alias("n"), F.min("mode").alias("least"))


@query("a18_paired_files", "v_scene_files", sql="select stem as key, concat('img/', stem, '.jpg') as image, concat('gt/', stem, '.png') as label from v_scene_files where has_pre = 1 and has_post = 1")
def paired_files(files: DataFrame) -> DataFrame:
    listed = lambda has, folder, end: files.where(f"{has} = 1").select(F.concat(F.lit(folder), "stem", F.lit(end)).alias("path"))
    return readers.paired_files(listed("has_pre", "img/", ".jpg"), listed("has_post", "gt/", ".png"), r"/([^/]+)\.(?:jpg|png)$")


@query("a19_proposals", "v_boxes", sql="""with n as (select image_id, count(*) as n, max(score) as best, min(score) as least from v_boxes where is_gt = 0 group by image_id)
select t.image_id, n, best, least from (select distinct image_id from v_boxes where is_gt = 1) t join n using (image_id)""")
def proposals(boxes: DataFrame) -> DataFrame:
    lists = boxes.where("is_gt = 0").groupBy(F.col("image_id").alias("ids")).agg(F.collect_list("score").alias("logits"), F.collect_list(F.array("x0", "y0", "x1", "y1")).alias("boxes"))
    held = readers.with_proposals(boxes.where("is_gt = 1").select("image_id").distinct(), lists)
    return held.select("image_id", F.size("proposals").cast("long").alias("n"), F.col("proposals")[0]["score"].alias("best"), F.element_at("proposals", -1)["score"].alias("least"))


@query("a10_log_lines", "v_progress", sql="""select task % 16 as log, row_number() over (partition by task % 16 order by ts, event_id) as line_no, concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' task ', cast(task as varchar), ' ', status) as value from v_progress""")
def log_lines(progress: DataFrame) -> DataFrame:
    """Sixteen logs, written as text and read back with the numbers of their lines."""
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" task "), F.col("task").cast("string"), F.lit(" "), F.col("status"))
    path = _path(progress, "logs")
    logs = progress.withColumn("log", F.col("task") % 16).repartition("log").sortWithinPartitions("log", "ts", "event_id")
    logs.select("log", line.alias("value")).write.partitionBy("log").text(path)
    read = readers.log_lines(progress.sparkSession, path)
    return read.select(F.regexp_extract("file", r"/log=(\d+)/", 1).cast("long").alias("log"), "line_no", "value")


@query("a12_numbers", "v_scalars", sql="select iter - 1 as at, value from v_scalars where name = 'click' and iter % 5 <> 0")
def numbers(scalars: DataFrame) -> DataFrame:
    """A series as a table of a number a line, in which every fifth line is empty."""
    path = _path(scalars, "numbers")
    one = scalars.where("name = 'click'").coalesce(1).sortWithinPartitions("iter")
    one.select(F.when(F.col("iter") % 5 == 0, "").otherwise(F.col("value").cast("string")).alias("value")).write.text(path)
    return readers.numbers(scalars.sparkSession, path)


@query("b1_class_raster", "v_cells", sql="select scene_id, r // 16 as tile_row, count(*) as cells, cast(sum(post_class) as bigint) as total from v_cells where post_class <> 0 group by all")
def class_raster(cells: DataFrame) -> DataFrame:
    """Written in tiles, and read back."""
    path = _path(cells, "raster")
    writers.class_raster(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), path, tile=16)
    read = cells.sparkSession.read.parquet(path)
    return read.groupBy(F.col("scene_id").cast("long").alias("scene_id"), F.col("tile_row").cast("long").alias("tile_row")).agg(F.count("*").alias("cells"), F.sum("v").alias("total"))


@query("b3_raw_change", "v_scene_files", sql="select stem as geometry, '' as precode, cast(split_part(stem, '_', 3) as int) - 1 as preyear, '' as currcode, cast(split_part(stem, '_', 3) as int) as curryear from v_scene_files where has_post = 1")
def raw_change(files: DataFrame) -> DataFrame:
    change = files.where("has_post = 1").withColumn("geometry", F.col("stem"))
    # The year in a name is a run of four digits of its own; the number of the scene isn't part of it.
    return writers.raw_change(change, F.concat(F.lit("S_"), F.element_at(F.split("stem", "_"), 3)))


@query("b6_progress_messages", "v_progress", sql="select cast(task as varchar) as key, 'progress' as kind, strftime(ts, '%Y-%m-%d %H:%M:%S') as sent, cast(cur as varchar) as cur, status from v_progress")
def progress_messages(progress: DataFrame) -> DataFrame:
    sent = writers.messages(progress, "task", {"cur": F.col("cur"), "status": F.col("status")})
    field = lambda p, n: F.get_json_object("value", f"$.{p}").alias(n)
    return sent.select("key", field("messageType", "kind"), field("sendTime", "sent"), field("messageContent.cur", "cur"), field("messageContent.status", "status"))


@query("b9_prediction_rows", "v_boxes", sql="select image_id, category_id, x0 as x, y0 as y, x1 - x0 as w, y1 - y0 as h, score from v_boxes where is_gt = 0")
def prediction_rows(boxes: DataFrame) -> DataFrame:
    rows = writers.prediction_rows(boxes.where("is_gt = 0"))
    return rows.select("image_id", "category_id", *[F.col("bbox")[i].alias(n) for i, n in enumerate("xywh")], "score")


@query("b11_tile_manifest", "v_scene_files", sql="""with s as (select stem, scene_key % 90 + 20 as width, scene_key % 70 + 30 as height from v_scene_files), r as (select *, unnest(range(0, cast(ceil(height / 32.0) as bigint))) as i from s),
t as (select *, unnest(range(0, cast(ceil(width / 32.0) as bigint))) as j from r)
select stem as scene, concat(cast(i as varchar), '_', cast(j as varchar)) as id, 10 + j * 64.0e0 as x0, 500 - least((i + 1) * 32, height) * 2.0e0 as y0, 10 + least((j + 1) * 32, width) * 2.0e0 as x1, 500 - i * 64.0e0 as y1 from t""")
def tile_manifest(files: DataFrame) -> DataFrame:
    scenes = files.select(F.col("stem").alias("scene"), F.lit(10.0).alias("left"), F.lit(500.0).alias("top"), F.lit(2.0).alias("res"), (F.col("scene_key") % 90 + 20).alias("width"), (F.col("scene_key") % 70 + 30).alias("height"))
    return writers.tile_manifest(scenes, 32)


@query("b12_sample_manifest", "v_scene_files", sql="""with f as (select stem, scene_key as ord, scene_key % 7 * 1000000 as bytes from v_scene_files order by scene_key limit 60), s as (select *, sum(bytes) over (order by ord rows unbounded preceding) as upto from f)
select stem, ord, bytes from s where upto <= 52428800""")
def sample_manifest(files: DataFrame) -> DataFrame:
    return writers.sample_manifest(files.select("stem", F.col("scene_key").alias("ord"), (F.col("scene_key") % 7 * 1000000).alias("bytes")))


@query("b13_swap_variables", "v_scalars", sql="""select concat('##SWAP:', name, '=', '{"value":', cast(count(*) as varchar), '}') as value from v_scalars group by name""")
def swap_variables(scalars: DataFrame) -> DataFrame:
    return writers.swap_variables(scalars.groupBy(F.col("name").alias("key")).agg(F.count("*").alias("value")))


@query("h28_cropped", "v_cells", sql="""select a.scene_id, b.r, b.c, a.pre_class, b.post_class from v_cells a join v_cells b on a.scene_id = b.scene_id and a.r - a.scene_id % 5 = b.r and a.c - a.scene_id % 7 = b.c""")
def cropped(cells: DataFrame) -> DataFrame:
    """The later grid lies some cells right of and below the earlier one; both are cut to what they share."""
    scenes = cells.select("scene_id").distinct()
    size = {f"{s}_{n}": F.lit(64) for s in "ab" for n in ("width", "height")}
    grids = scenes.withColumns({"a_x": F.lit(0.0), "a_y": F.lit(0.0), "b_x": F.col("scene_id") % 7 * 2.0, "b_y": F.col("scene_id") % 5 * 2.0, "res": F.lit(2.0), **size})
    windows = runs.overlap_window(grids, "width", "height")
    one = runs.cropped(cells.select("scene_id", "r", "c", "pre_class"), windows, "a", "scene_id")
    return one.join(runs.cropped(cells.select("scene_id", "r", "c", "post_class"), windows, "b", "scene_id"), ["scene_id", "r", "c"])
