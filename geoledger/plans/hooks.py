"""Queries over a user's own functions, and over centre lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions import geometry
from geoledger.operators import hooks, layers, lines
from geoledger.plans.catalog import query


@query("u4_finished_layer", "v_polygons", sql="""select fid, cast((least(x1, 40) - greatest(x0, 10)) * (least(y1, 45) - greatest(y0, 5)) as double) as area from v_polygons
 where least(x1, 40) > greatest(x0, 10) and least(y1, 45) > greatest(y0, 5)""")
def finished_layer(polygons: DataFrame) -> DataFrame:
    """Holes filled, rings thinned, cut to a region, each by a function of the layer."""
    x = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    holed = polygons.select("fid", F.concat(geometry.rectangle(*x), geometry.rectangle(x[0] + 1, x[1] + 1, x[0] + 2, x[1] + 2)).alias("rings"))
    region = [(10.0, 5.0), (40.0, 5.0), (40.0, 45.0), (10.0, 45.0)]
    done = hooks.finished(holed, lambda df: df.withColumn("rings", geometry.without_holes(F.col("rings"))), lambda df: layers.simplified(df, "rings", 0.1), lambda df: layers.clipped(df, "rings", region))
    return done.select("fid", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"))


@query("u6_mapped_rows", "v_boxes", sql="select box_id, (x1 - x0) * (y1 - y0) as area from v_boxes where is_gt = 0 and score >= 0.5")
def mapped_rows(boxes: DataFrame) -> DataFrame:
    change = lambda r: {"box_id": r["box_id"], "area": (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])} if r["score"] >= 0.5 else None
    return hooks.mapped_rows(boxes.where("is_gt = 0").select("box_id", "x0", "y0", "x1", "y1", "score"), change, "box_id long, area double")


@query("u8_polygon_cells", "v_polygons", sql="select fid, r, count(*) as cells, min(c) as c0 from (select fid, r, unnest(range(x0, x1)) as c from (select *, unnest(range(y0, y1)) as r from v_polygons)) group by fid, r")
def polygon_cells(polygons: DataFrame) -> DataFrame:
    shaped = polygons.select("fid", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    return hooks.polygon_cells(shaped, "rings", ["fid"]).groupBy("fid", "r").agg(F.count("*").alias("cells"), F.min("c").alias("c0"))


@query("h41_road_graph", "v_cells")
def road_graph(cells: DataFrame) -> DataFrame:
    """Of each scene: vertices, edges and simplified points of its centre lines."""
    thin = lines.thinned(cells.where("post_class > 4"))
    vertices, edges, members = lines.line_graph(thin)
    drawn = lines.lines_of(edges, members, 1.0).groupBy("scene_id").agg(F.sum(F.size("points")).alias("points"))
    found = vertices.groupBy("scene_id").agg(F.count("*").alias("vertices"), F.sum("degree").cast("long").alias("degrees"))
    joined = found.join(edges.groupBy("scene_id").agg(F.count("*").alias("edges"), F.sum("cells").alias("cells")), "scene_id", "full").join(drawn, "scene_id", "left")
    return joined.select("scene_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("vertices", "degrees", "edges", "cells", "points")])


@query("u5_loaded_labels", "v_cells", sql="""select concat(cast(scene_id as varchar), '/', cast(r as varchar)) as path, cast(0 as bigint) as r, row_number() over (partition by scene_id, r order by c) - 1 as c, cast(post_class as bigint) as v from v_cells""")
def loaded_labels(cells: DataFrame) -> DataFrame:
    """A row of a scene as a file of numbers with commas, decoded by a function of the user's."""
    row = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c", "post_class"))), lambda x: x["post_class"].cast("string")), ",")
    path = F.concat(F.col("scene_id").cast("string"), F.lit("/"), F.col("r").cast("string"))
    files = cells.groupBy("scene_id", "r").agg(F.encode(row, "UTF-8").alias("content")).select(path.alias("path"), "content")
    return hooks.loaded_labels(files, lambda content: [[int(x) for x in line.split(",")] for line in content.decode().splitlines()])
