"""Writers. Spark's committer makes each write whole or absent; empty results keep their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.functions.boxes import box, to_xywh

FINAL = "uid long, pre_code int, pre_name string, curr_code int, curr_name string, province string, geometry string"


def class_raster(cells: DataFrame, path: str, tile: int = 512) -> None:
    """Cells as a table partitioned by scene and row of tiles; classes in eight bits, 0 is no data and isn't stored."""
    rows = cells.where("v != 0").select("scene_id", F.floor(F.col("r") / F.lit(float(tile))).alias("tile_row"), "r", "c", F.col("v").cast("short"))
    rows.repartition("scene_id", "tile_row").write.partitionBy("scene_id", "tile_row").parquet(path)


def final_layer(features: DataFrame, path: str) -> None:
    """The seven columns of a result; an empty one too."""
    empty = features.sparkSession.createDataFrame([], FINAL)
    empty.unionByName(features.select(*empty.columns)).write.parquet(path)


def raw_change(features: DataFrame, post_name: Column) -> DataFrame:
    """precode, preyear, currcode, curryear of raw change polygons: the year before is always one less."""
    from geoledger.functions.text import year_in_name

    year = year_in_name(post_name)
    return features.select("geometry", F.lit("").alias("precode"), (year - 1).alias("preyear"), F.lit("").alias("currcode"), year.alias("curryear"))


def geojson_lines(features: DataFrame, rings: str, properties: list[str]) -> DataFrame:
    """A GeoJSON feature per row, as text."""
    coordinates = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return features.select(F.to_json(feature).alias("value"))


def messages(events: DataFrame, task: str, content: dict[str, Column]) -> DataFrame:
    """Progress envelopes as (key, value) rows for a Kafka writer: the ordered keys and the map of their values."""
    values = F.create_map(*[x for k, v in content.items() for x in (F.lit(k), v.cast("string"))])
    envelope = F.struct(F.lit("progress").alias("messageType"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sendTime"), F.col(task).cast("string").alias("taskId"), F.array(*[F.lit(k) for k in content]).alias("messageKey"), values.alias("messageContent"))
    return events.select(F.col(task).cast("string").alias("key"), F.to_json(envelope).alias("value"))


def swap_variables(values: DataFrame) -> DataFrame:
    """Lines that hand (key, value) rows on to the next step."""
    return values.select(F.concat(F.lit("##SWAP:"), F.col("key"), F.lit("="), F.to_json(F.struct("value"))).alias("value"))


def coco_rows(boxes: DataFrame) -> DataFrame:
    """Annotations of an image's boxes: id from 1 within the image, corner and size to three decimals, area."""
    x, y, w, h = to_xywh(box())
    at = F.row_number().over(Window.partitionBy("image_id").orderBy("box_id"))
    return boxes.select(at.alias("id"), "image_id", "category_id", F.array(*[F.round(v, 3) for v in (x, y, w, h)]).alias("bbox"), F.round(w * h, 3).alias("area"), F.lit(0).alias("iscrowd"))


def prediction_rows(boxes: DataFrame) -> DataFrame:
    """Detections as image_id, category_id, bbox (corner and size), score."""
    return boxes.select("image_id", "category_id", F.array(*to_xywh(box())).alias("bbox"), "score")


def tile_manifest(scenes: DataFrame, block: int) -> DataFrame:
    """(scene, id ``row_col``, x0, y0, x1, y1) of the blocks of scenes with left, top, res, width and height, cut at their right and lower edges."""
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / block).cast("int") - 1))
    each = scenes.withColumn("row", upto("height")).withColumn("col", upto("width"))
    x = lambda k: F.col("left") + F.least((F.col("col") + k) * block, F.col("width")) * F.col("res")
    y = lambda k: F.col("top") - F.least((F.col("row") + k) * block, F.col("height")) * F.col("res")
    return each.select("scene", F.concat_ws("_", "row", "col").alias("id"), x(0).alias("x0"), y(1).alias("y0"), x(1).alias("x1"), y(0).alias("y1"))


def sample_manifest(samples: DataFrame, most_rows: int = 60, most_bytes: int = 50 << 20) -> DataFrame:
    """Samples for review in their order, as many as the bounds allow: rows, and bytes so far. The bounds keep them few."""
    first = samples.orderBy("ord").limit(most_rows)
    so_far = F.sum("bytes").over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return first.withColumn("_so_far", so_far).where(F.col("_so_far") <= most_bytes).drop("_so_far")
