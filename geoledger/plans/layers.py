"""Queries over polygons: overlaps, attribution, areas, coordinates, merging of layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions import classes, geometry
from geoledger.operators import layers, overlay, raster
from geoledger.plans.catalog import query

_SHARED = "(least(p.x1, b.x1) - greatest(p.x0, b.x0)) * (least(p.y1, b.y1) - greatest(p.y0, b.y0))"
_MEET = "p.x0 < b.x1 and b.x0 < p.x1 and p.y0 < b.y1 and b.y0 < p.y1"


@query("j7_max_overlap", "v_polygons", "v_provinces", sql=f"""with q as (select p.fid, b.name, row_number() over (partition by p.fid order by {_SHARED} desc, b.ord) as k from v_polygons p join v_provinces b on {_MEET})
select p.fid, q.name from v_polygons p left join q on p.fid = q.fid and k = 1""")
def max_overlap(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    return overlay.max_overlap(polygons, provinces, "fid", "ord", "name").select("fid", "name")


@query("j8_land_use_backfill", "v_polygons", "v_provinces", sql=f"""with s as (select ord, ord % 5 as county, case when ord % 3 = 0 then 0 else 110 + ord end as land_use, x0, y0, x1, y1 from v_provinces),
b as (select p.fid, b.county, b.land_use, row_number() over (partition by p.fid, b.county order by {_SHARED} desc, b.ord) as k from v_polygons p join s b on {_MEET}),
f as (select fid, land_use, row_number() over (partition by fid order by county) as k from b where k = 1 and land_use <> 0)
select p.fid, case when p.fid % 4 <> 0 then p.fid % 4 else coalesce(case when land_use between 111 and 115 then 11 when land_use between 121 and 125 then 12 else land_use end, 0) end as code
 from v_polygons p left join f on p.fid = f.fid and f.k = 1""")
def land_use_backfill(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    sources = provinces.withColumns({"county": F.col("ord") % 5, "land_use": F.when(F.col("ord") % 3 == 0, 0).otherwise(110 + F.col("ord"))})
    coded = polygons.withColumn("code", F.col("fid") % 4)
    return overlay.backfilled(coded, sources, "fid", "ord", "county", classes.collapsed_land_use(F.col("land_use"))).select("fid", "code")


@query("j9_province_attribution", "v_polygons", "v_provinces", sql=f"""with q as (select p.fid, b.name, row_number() over (partition by p.fid order by
 case when p.x0 >= b.x0 and p.y0 >= b.y0 and p.x1 <= b.x1 and p.y1 <= b.y1 then 0 else 1 end, case when p.x0 >= b.x0 and p.y0 >= b.y0 and p.x1 <= b.x1 and p.y1 <= b.y1 then b.ord end, {_SHARED} desc, b.ord) as k
 from v_polygons p join v_provinces b on {_MEET}) select p.fid, coalesce(q.name, 'unknown') as province from v_polygons p left join q on p.fid = q.fid and k = 1""")
def province_attribution(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    return overlay.attributed(polygons, provinces, "fid", "name", "ord").select("fid", "province")


@query("d11_matched_counts", "v_polygons", "v_provinces", sql=f"""select count(*) as total, cast(sum(case when exists (select 1 from v_provinces b where {_MEET} and b.ord < 12) then 1 else 0 end) as bigint) as matched from v_polygons p""")
def matched_counts(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    some = overlay.attributed(polygons, provinces.where("ord < 12"), "fid", "name", "ord")
    return some.agg(F.count("*").alias("total"), F.count_if(F.col("province") != "unknown").alias("matched"))


@query("j6_footprint_sheets", "v_polygons", "v_provinces", sql=f"select p.scene_id, count(distinct b.name) as sheets, count(distinct b.ord % 5) as counties from v_polygons p join v_provinces b on {_MEET} group by p.scene_id")
def footprint_sheets(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    pairs = overlay.overlapping(polygons, provinces)
    return pairs.groupBy("a.scene_id").agg(F.count_distinct("b.name").alias("sheets"), F.count_distinct(F.col("b.ord") % 5).alias("counties"))


@query("c10_roi_tiles", "v_cells", "v_provinces", sql="""with t as (select distinct scene_id, cast(r // 8 as bigint) as tr, cast(c // 8 as bigint) as tc from v_cells)
select scene_id, tr, tc from t where exists (select 1 from v_provinces b where ord in (6, 7, 12) and tc * 8 < b.x1 and b.x0 < tc * 8 + 8 and tr * 8 < b.y1 and b.y0 < tr * 8 + 8)""")
def roi_tiles(cells: DataFrame, provinces: DataFrame) -> DataFrame:
    at = lambda c: F.floor(F.col(c) / F.lit(8.0))
    tiles = cells.select("scene_id", at("r").alias("tr"), at("c").alias("tc")).distinct()
    boxes = tiles.withColumns({"x0": F.col("tc") * 8, "y0": F.col("tr") * 8, "x1": F.col("tc") * 8 + 8, "y1": F.col("tr") * 8 + 8})
    roi = provinces.where(F.col("ord").isin(6, 7, 12)).select("x0", "y0", "x1", "y1")
    return overlay.overlapping(boxes, roi).select("a.scene_id", "a.tr", "a.tc").distinct()


@query("c11_h37_roi_cells", "v_cells", "v_provinces", sql="""select scene_id, count(*) as cells from v_cells k where exists (select 1 from v_provinces b where ord in (6, 7, 12) and c >= b.x0 and c < b.x1 and r >= b.y0 and r < b.y1)
 and not (c >= 18 and c < 22 and r >= 16 and r < 20) group by scene_id""")
def roi_cells(cells: DataFrame, provinces: DataFrame) -> DataFrame:
    """Cells whose centres are inside the region; its first part has a hole."""
    x = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    hole = geometry.rectangle(F.lit(18), F.lit(16), F.lit(22), F.lit(20))
    rings = F.when(F.col("ord") == 6, F.concat(geometry.rectangle(*x), hole)).otherwise(geometry.rectangle(*x))
    roi = provinces.where(F.col("ord").isin(6, 7, 12)).withColumn("rings", rings).select("x0", "x1", "y0", "y1", "rings")
    points = cells.withColumns({"px": F.col("c") + 0.5, "py": F.col("r") + 0.5})
    banded = points.withColumn("band", F.floor(F.col("py") / F.lit(16.0)))
    dealt = roi.withColumn("band", F.explode(F.sequence(F.floor(F.col("y0") / F.lit(16.0)), F.floor(F.col("y1") / F.lit(16.0)))))
    inside = (F.col("px") >= F.col("x0")) & (F.col("px") < F.col("x1")) & geometry.contains(F.col("rings"), F.col("px"), F.col("py"))
    return banded.join(dealt, "band").where(inside).select("scene_id", "r", "c").distinct().groupBy("scene_id").agg(F.count("*").alias("cells"))


@query("g6_dissolved_area", "v_polygons", sql="select scene_id, count(distinct (y * 1000 + x)) as cells from (select scene_id, x, unnest(range(y0, y1)) as y from (select *, unnest(range(x0, x1)) as x from v_polygons)) group by scene_id")
def dissolved_area(polygons: DataFrame) -> DataFrame:
    """Cells that any polygon of a scene covers: the area of their union on the grid."""
    return layers.union_cells(polygons).groupBy("scene_id").agg(F.count("*").alias("cells"))


@query("c12_touched_cells", "v_polygons", sql="select scene_id, count(distinct (y * 1000 + x)) as cells from (select scene_id, x, unnest(range(y0, y1 + 1)) as y from (select *, unnest(range(x0, x1 + 1)) as x from v_polygons)) group by scene_id")
def touched_cells(polygons: DataFrame) -> DataFrame:
    wider = polygons.withColumns({"x1": F.col("x1") + 1, "y1": F.col("y1") + 1})
    return layers.union_cells(wider).groupBy("scene_id").agg(F.count("*").alias("cells"))


@query("h32_area_length", "v_polygons", sql="select fid, round(((x1 - x0) * (y1 - y0) - 1) * 1.0e0, 6) as area, round(2.0e0 * (x1 - x0 + y1 - y0), 6) as length from v_polygons")
def area_length(polygons: DataFrame) -> DataFrame:
    x = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    hole = geometry.rectangle(x[0] + 1, x[1] + 1, x[0] + 2, x[1] + 2)
    shaped = polygons.withColumn("rings", F.concat(geometry.rectangle(*x), hole))
    return shaped.select("fid", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"), F.round(geometry.ring_length(F.col("rings")[0]), 6).alias("length"))


@query("h33_filled_holes", "v_polygons", sql="select fid, round((x1 - x0) * (y1 - y0) * 1.0e0, 6) as area, cast(1 as int) as rings from v_polygons")
def filled_holes(polygons: DataFrame) -> DataFrame:
    x = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    shaped = F.concat(geometry.rectangle(*x), geometry.rectangle(x[0] + 1, x[1] + 1, x[0] + 2, x[1] + 2))
    filled = polygons.withColumn("rings", geometry.without_holes(shaped))
    return filled.select("fid", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"), F.size("rings").alias("rings"))


@query("c6_area_filter", "v_polygons", sql="select fid, cast((x1 - x0) * (y1 - y0) as double) as area_m2 from v_polygons where (x1 - x0) * (y1 - y0) >= 100")
def area_filter(polygons: DataFrame) -> DataFrame:
    rings = geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    return polygons.select("fid", geometry.polygon_area(rings).alias("area_m2")).where("area_m2 >= 100")


@query("d30_extent", "v_polygons", sql="select scene_id, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from v_polygons group by scene_id")
def extent(polygons: DataFrame) -> DataFrame:
    return polygons.groupBy("scene_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("h31_pixel_to_world", "v_cells", sql="select scene_id, r, c, round(100 + c * 0.5e0 + r * 0.25e0, 6) as x, round(200 + c * 0.25e0 - r * 2.0e0, 6) as y from v_cells")
def pixel_to_world(cells: DataFrame) -> DataFrame:
    gt = F.array(*[F.lit(v) for v in (100.0, 0.5, 0.25, 200.0, 0.25, -2.0)])
    x, y = geometry.to_world(gt, F.col("c"), F.col("r"))
    return cells.select("scene_id", "r", "c", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("h48_mercator", "customer", sql="""with p as (select c_custkey, c_custkey % 360 - 180.0e0 as lon, c_custkey % 170 - 85.0e0 as lat from customer),
m as (select *, lon * pi() * 6378137.0 / 180 as x, ln(tan((lat + 90) * pi() / 360)) * 6378137.0 as y from p)
select c_custkey, round(x, 3) as x, round(y, 3) as y, round(x * 180 / (pi() * 6378137.0), 6) as lon, round(atan(exp(y / 6378137.0)) * 360 / pi() - 90, 6) as lat from m""")
def mercator(customer: DataFrame) -> DataFrame:
    p = customer.select("c_custkey", (F.col("c_custkey") % 360 - 180.0).alias("lon"), (F.col("c_custkey") % 170 - 85.0).alias("lat"))
    x, y = geometry.to_mercator(F.col("lon"), F.col("lat"))
    m = p.select("c_custkey", x.alias("x"), y.alias("y"))
    lon, lat = geometry.from_mercator(F.col("x"), F.col("y"))
    return m.select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("h35_wkt_round_trip", "v_polygons", sql="select fid, true as same, cast((x1 - x0) * (y1 - y0) as double) as area from v_polygons")
def wkt_round_trip(polygons: DataFrame) -> DataFrame:
    shaped = polygons.withColumn("rings", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    read = shaped.withColumn("again", geometry.from_wkt(geometry.to_wkt(F.col("rings"))))
    return read.select("fid", (F.to_json("again") == F.to_json("rings")).alias("same"), geometry.polygon_area(F.col("again")).alias("area"))


@query("g1_layer_merge", "v_polygons", "v_provinces", sql="select fid, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, null::varchar as name from v_polygons union all select null, x0, y0, name from v_provinces")
def layer_merge(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    template = polygons.select("fid", F.col("x0").cast("long"), F.col("y0").cast("long"), F.lit(None).cast("string").alias("name"))
    return layers.merged(template, [polygons, provinces])


@query("g2_concat", "v_polygons", "v_provinces", sql="select scene_id, fid, name from v_polygons full join (select cast(null as bigint) as k, name from v_provinces) b on fid = b.k")
def concat(polygons: DataFrame, provinces: DataFrame) -> DataFrame:
    return polygons.select("scene_id", "fid").unionByName(provinces.select("name"), allowMissingColumns=True)


@query("h39_polygonize_area", "v_cells", sql="select scene_id, v, count(*) as cells from (select scene_id, post_class % 3 as v from v_cells) where v > 0 group by all")
def polygonize_area(cells: DataFrame) -> DataFrame:
    """Areas of the polygons of all regions, by class: they must add up to the cells."""
    some = cells.select("scene_id", "r", "c", (F.col("post_class") % 3).alias("v")).where("v > 0")
    shapes = layers.polygonize(raster.components(some, 64))
    return shapes.groupBy("scene_id", "v").agg(F.round(F.sum(geometry.polygon_area(F.col("rings")))).cast("long").alias("cells"))


@query("h39_ranked_rings", "v_cells", sql="select scene_id, v, count(*) as cells from (select scene_id, post_class % 3 as v from v_cells) where v > 0 group by all")
def ranked_rings(cells: DataFrame) -> DataFrame:
    """The same with all rings ordered by pointer doubling, as those of large regions are."""
    some = cells.select("scene_id", "r", "c", (F.col("post_class") % 3).alias("v")).where("v > 0")
    shapes = layers.polygonize(raster.components(some, 64), in_task=0)
    return shapes.groupBy("scene_id", "v").agg(F.round(F.sum(geometry.polygon_area(F.col("rings")))).cast("long").alias("cells"))


@query("h40_repaired", "v_polygons", sql="select fid, cast((x1 - x0) * (y1 - y0) as double) as area, cast(5 as int) as vertices from v_polygons")
def repaired(polygons: DataFrame) -> DataFrame:
    """Rings left open, with a vertex twice, are closed and thinned."""
    ring = geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])[0]
    broken = F.array(F.concat(F.slice(ring, 1, 2), F.slice(ring, 2, 3)))
    fixed = polygons.withColumn("rings", layers.repaired(broken))
    return fixed.select("fid", geometry.polygon_area(F.col("rings")).alias("area"), F.size(F.col("rings")[0]).alias("vertices"))


@query("h40_made_valid", "v_polygons", sql="""select fid, 2 as parts, (x1 - x0) * (y1 - y0) / 2.0e0 as area from v_polygons""")
def made_valid(polygons: DataFrame) -> DataFrame:
    """Rectangles whose upper corners are exchanged: figures of eight, that become two triangles of half the area together."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    eight = F.array(p(x0, y0), p(x1, y0), p(x0, y1), p(x1, y1), p(x0, y0))
    out = layers.made_valid(polygons.select("fid", F.array(eight).alias("rings")), "rings")
    return out.groupBy("fid").agg(F.count("*").cast("int").alias("parts"), F.round(F.sum(geometry.polygon_area(F.col("rings"))), 6).alias("area"))


#: A region with a bay on its right side and a hole, on the grid.
_REGION = [[(8.0, 4.0), (40.0, 4.0), (40.0, 16.0), (24.0, 16.0), (24.0, 30.0), (40.0, 30.0), (40.0, 44.0), (8.0, 44.0)], [(12.0, 20.0), (18.0, 20.0), (18.0, 27.0), (12.0, 27.0)]]


@query("h36_clip_to_region", "v_polygons", sql="""select fid, cast(count(*) as double) as area from v_polygons, range(0, 64) a(x), range(0, 64) b(y)
 where x >= x0 and x < x1 and y >= y0 and y < y1 and x >= 8 and x < 40 and y >= 4 and y < 44 and not (x >= 24 and y >= 16 and y < 30) and not (x >= 12 and x < 18 and y >= 20 and y < 27) group by fid""")
def clip_to_region(polygons: DataFrame) -> DataFrame:
    """Areas of polygons cut to a concave region with a hole; the twin counts cells."""
    shaped = polygons.select("fid", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    cut = layers.clipped_to(shaped, "rings", _REGION)
    return cut.groupBy("fid").agg(F.round(F.sum(geometry.polygon_area(F.col("rings"))), 6).alias("area"))


@query("h36_clip_to_roi", "v_polygons", sql="""select fid, cast((least(x1, 40) - greatest(x0, 10)) * (least(y1, 45) - greatest(y0, 5)) as double) as area from v_polygons
 where least(x1, 40) > greatest(x0, 10) and least(y1, 45) > greatest(y0, 5)""")
def clip_to_roi(polygons: DataFrame) -> DataFrame:
    shaped = polygons.select("fid", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    cut = layers.clipped(shaped, "rings", [(10.0, 5.0), (40.0, 5.0), (40.0, 45.0), (10.0, 45.0)])
    return cut.select("fid", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"))


@query("h34_simplified", "v_polygons", sql="select fid, cast((x1 - x0) * (y1 - y0) as double) as area, cast(5 as int) as vertices from v_polygons")
def simplified(polygons: DataFrame) -> DataFrame:
    """Points on the edges go; the corners stay."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(p(x0, y0), p((x0 + x1) / 2, y0), p(x1, y0), p(x1, (y0 + y1) / 2), p(x1, y1), p(x0, y1), p(x0, y0))
    out = layers.simplified(polygons.select("fid", F.array(ring).alias("rings")), "rings", 0.1)
    return out.select("fid", geometry.polygon_area(F.col("rings")).alias("area"), F.size(F.col("rings")[0]).alias("vertices"))


@query("h52_smoothed", "v_polygons")
def smoothed(polygons: DataFrame) -> DataFrame:
    shaped = polygons.select("fid", geometry.rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    out = layers.smoothed(shaped, "rings", 2.0)
    return out.select("fid", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"), F.size(F.col("rings")[0]).alias("vertices"))


@query("c1_result_projection", "v_polygons", sql="""select fid as uid, case when fid % 5 = 0 then 0 else cast(fid % 7 as int) end as pre_code,
 case when fid % 5 = 0 then 'unknown' else case fid % 7 when 1 then 'cropland' when 2 then 'woodland' when 3 then 'grassland' when 4 then 'water' when 5 then 'built-up' when 6 then 'bare land' else 'unknown' end end as pre_name,
 0 as curr_code, 'unknown' as curr_name, 'unknown' as province, null::varchar as geometry from v_polygons""")
def result_projection(polygons: DataFrame) -> DataFrame:
    from geoledger.operators.zonal import format_result

    return format_result(polygons.select(F.col("fid").alias("uid"), F.when(F.col("fid") % 5 != 0, F.col("fid") % 7).alias("pre_code")))
