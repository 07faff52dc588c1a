"""Queries over cells: zones, histograms, stretches, neighbourhoods, tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions.classes import UNKNOWN, NAMES, major_class
from geoledger.operators import raster, zonal
from geoledger.plans.catalog import query

_MAJOR = "case when {0} in (1,2) then 1 when {0} in (3,4) then 2 when {0} = 5 then 3 when {0} = 11 then 4 when {0} in (6,7,8,9) then 5 when {0} in (10,12,13) then 6 else 0 end"
_NAME = "case {0} " + " ".join(f"when {k} then '{v}'" for k, v in NAMES.items()) + f" else '{UNKNOWN}' end"
_INSIDE = "p.scene_id = k.scene_id and k.c >= p.x0 and k.c < p.x1 and k.r >= p.y0 and k.r < p.y1"
_LAYERS = f"""layers as (select p.scene_id, p.fid, 'pre_class' as layer, k.pre_class as cls from v_polygons p join v_cells k on {_INSIDE}
 union all select p.scene_id, p.fid, 'post_class', k.post_class from v_polygons p join v_cells k on {_INSIDE}),
counts as (select scene_id, fid, layer, cls, count(*) as n from layers where cls <> 0 group by all)"""
_MAJORS = f"""with {_LAYERS}, m as (select scene_id, fid, layer, {_MAJOR.format('cls')} as code, sum(n) as n from counts group by all),
best as (select scene_id, fid, layer, code, row_number() over (partition by scene_id, fid, layer order by n desc, code) as k from m where code <> 0)"""


@query("entry_transition_report", "v_polygons", "v_cells", sql=f"""{_MAJORS},
w as (select p.scene_id, p.fid, coalesce(max(case when layer = 'pre_class' then code end), 0) as pre_code, coalesce(max(case when layer = 'post_class' then code end), 0) as curr_code
 from v_polygons p left join best b on p.scene_id = b.scene_id and p.fid = b.fid and b.k = 1 group by all)
select pre_code, {_NAME.format('pre_code')} as pre_name, curr_code, {_NAME.format('curr_code')} as curr_name, count(*) as polygons from w group by all""")
def entry_transition_report(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    return zonal.transitions(polygons, cells)


@query("j10_d1_zonal_counts", "v_polygons", "v_cells", sql=f"with {_LAYERS} select scene_id, fid, layer, cls, n from counts")
def zonal_counts(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    return zonal.zonal_counts(polygons, cells, ["pre_class", "post_class"])


@query("d2_merged_majority", "v_polygons", "v_cells", sql=f"{_MAJORS} select scene_id, fid, layer, code from best where k = 1 union all "
       "select scene_id, fid, layer, 0 from m group by scene_id, fid, layer having max(code) = 0")
def merged_majority(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    return zonal.majority(zonal.zonal_counts(polygons, cells, ["pre_class", "post_class"]), ["scene_id", "fid", "layer"], major_class(F.col("cls")))


@query("d3_legacy_majority", "v_polygons", "v_cells", sql=f"""with {_LAYERS},
f as (select scene_id, fid, layer, cls, row_number() over (partition by scene_id, fid, layer order by n desc, cls) as k from counts)
select p.scene_id, p.fid, coalesce({_MAJOR.format('f.cls')}, 5) as code from v_polygons p left join f on p.scene_id = f.scene_id and p.fid = f.fid and f.k = 1 and f.layer = 'post_class'
 where f.cls is not null union all select p.scene_id, p.fid, 5 from v_polygons p where not exists (select 1 from f where f.scene_id = p.scene_id and f.fid = p.fid and f.layer = 'post_class')""")
def legacy_majority(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    counts = zonal.zonal_counts(polygons, cells, ["post_class"])
    fine = counts.groupBy("scene_id", "fid").agg(F.max_by("cls", F.struct("n", -F.col("cls"))).alias("cls"))
    out = polygons.select("scene_id", "fid").join(fine, ["scene_id", "fid"], "left")
    return out.select("scene_id", "fid", F.when(F.col("cls").isNull(), 5).otherwise(major_class(F.col("cls"))).alias("code"))


_BAND = "select scene_id, r, c, (pre_class * 19 + post_class * 7) % 256 as v from v_cells"


def _band(cells: DataFrame) -> DataFrame:
    return cells.select("scene_id", "r", "c", ((F.col("pre_class") * 19 + F.col("post_class") * 7) % 256).alias("v"))


@query("d4_band_histogram", "v_cells", sql=f"with b as ({_BAND}) select scene_id, v, count(*) as n from b where v not in (0, 255) group by all")
def band_histogram(cells: DataFrame) -> DataFrame:
    return raster.histogram(_band(cells), ["scene_id"], "v", bins=256)


@query("d5_masked_histogram", "v_cells", sql=f"""with b as ({_BAND}) select scene_id, least(greatest(v, 3), 252) as v, count(*) as n from b
 where v <> 0 and (r * 64 + c) % 4 = 0 group by all having least(greatest(v, 3), 252) not in (3, 252)""".replace("group by all having", "group by scene_id, least(greatest(v, 3), 252) having"))
def masked_histogram(cells: DataFrame) -> DataFrame:
    return raster.sampled_histogram(_band(cells).withColumn("place", F.col("r") * 64 + F.col("c")), ["scene_id"], "v", "place", stride=4, no_data=0, edge=3)


_HIST = f"with b as ({_BAND}), h as (select scene_id, v, count(*) as n from b where v not in (0, 255) group by all)"
_CUM = f"{_HIST}, q as (select scene_id, v, n, sum(n) over (partition by scene_id order by v) * 1.0e0 / sum(n) over (partition by scene_id) as q from h)"


@query("d6_clip_values", "v_cells", sql=f"{_CUM} select scene_id, arg_min(v, (abs(q - 0.02), v)) as low, arg_min(v, (abs(q - 0.98), v)) as high from q group by scene_id")
def clip_values(cells: DataFrame) -> DataFrame:
    return raster.clip_values(raster.histogram(_band(cells), ["scene_id"], "v", bins=256), ["scene_id"], "v", 0.02)


@query("e3_cumulative_histogram", "v_cells", sql=f"{_CUM} select scene_id, v, round(q, 6) as q from q")
def cumulative_histogram(cells: DataFrame) -> DataFrame:
    return raster.cumulative(raster.histogram(_band(cells), ["scene_id"], "v", bins=256), ["scene_id"], "v").select("scene_id", "v", F.round("q", 6).alias("q"))


@query("d7_percentiles", "v_cells", sql=f"with b as ({_BAND}) select scene_id, round(quantile_cont(v, 0.02), 6) as low, round(quantile_cont(v, 0.98), 6) as high from b where v <> 0 group by scene_id")
def percentiles(cells: DataFrame) -> DataFrame:
    return raster.percentiles(_band(cells), ["scene_id"], "v").select("scene_id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("d8_band_moments", "v_cells", sql=f"with b as ({_BAND}) select scene_id, round(avg(v / 255.0e0), 6) as mean, round(stddev_pop(v / 255.0e0), 6) as std from b where v <> 0 group by scene_id")
def band_moments(cells: DataFrame) -> DataFrame:
    return raster.moments(_band(cells), ["scene_id"], "v").select("scene_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("d9_valid_fraction", "v_cells", sql="select scene_id, round(avg(case when pre_class <> 0 and post_class <> 0 then 1.0 else 0.0 end), 6) as valid from v_cells group by scene_id")
def valid_fraction(cells: DataFrame) -> DataFrame:
    valid = (F.col("pre_class") != 0) & (F.col("post_class") != 0)
    return cells.groupBy("scene_id").agg(F.round(F.avg(valid.cast("double")), 6).alias("valid"))


@query("h19_normalised", "v_cells", sql="select scene_id, r, c, round((pre_class / 255.0 - 0.485) / 0.229, 6) as z from v_cells")
def normalised(cells: DataFrame) -> DataFrame:
    return cells.select("scene_id", "r", "c", F.round(raster.normalised(F.col("pre_class"), 0.485, 0.229), 6).alias("z"))


@query("h20_percent_stretch", "v_cells", sql=f"""{_CUM}, k as (select scene_id, arg_min(v, (abs(q - 0.02), v)) as low, arg_min(v, (abs(q - 0.98), v)) as high from q group by scene_id)
select b.scene_id, r, c, cast(floor(least(greatest((v - low) * 255.0 / (high - low), 0), 255)) as int) as v from b join k using (scene_id)""")
def percent_stretch(cells: DataFrame) -> DataFrame:
    return raster.percent_stretch(_band(cells), ["scene_id"], "v", 0.02)


@query("h21_linear_stretch", "v_cells", sql=f"""with b as ({_BAND}), k as (select scene_id, quantile_cont(v, 0.02) as low, quantile_cont(v, 0.98) as high from b where v <> 0 group by scene_id)
select b.scene_id, r, c, cast(floor(least(greatest((v - low) * 255.0 / (high - low), 0), 255)) as int) as v from b join k using (scene_id)""")
def linear_stretch(cells: DataFrame) -> DataFrame:
    return raster.linear_stretch(_band(cells), ["scene_id"], "v")


def _stretch_sql(left: float, right: float, gamma: float) -> str:
    """The five-segment stretch of ``_BAND``, and its edges without data within 4 cells of the border."""
    weight = lambda a, b, part, least, most: f"least(greatest(({b} - {a}) / (high + 0.1e0) / {part}, {least} / 255.0e0), {most} / 255.0e0)"
    stage = lambda n, a, b, w: f"""s{n} as (select *, case when v >= {a} and v < {b} then ceil((least(v, high) - {a}) / ({b} - {a} + 1) * {w} * 255.0e0 + base) else x end as y from
 (select *, coalesce(max(case when v = {a} - 1 then x end) over (partition by scene_id), 1.0e0) as base from s{n - 1}))""".replace("from s" + str(n - 1), f"from (select * exclude (x, y, base), y as x from s{n - 1})")  # noqa: E731
    near = lambda p: f"arg_min(cast(v as double), (abs(q - {p!r}), v))"
    shifted = lambda of: f"(select scene_id, r + dy as r, c + dx as c, m from {of}, (values (0,0),(0,1),(1,0),(0,-1),(-1,0)) d(dy, dx))"
    around = lambda name, of, how: f"{name} as materialized (select k.scene_id, k.r, k.c, {how}(o.m) as m from {of} k join {shifted(of)} o on k.scene_id = o.scene_id and k.r = o.r and k.c = o.c group by all)"
    return f"""with b as materialized ({_BAND}), e as (select scene_id, min(v) * 1.0e0 as low, max(v) * 1.0e0 as high from b group by scene_id),
h as (select scene_id, v, count(*) as n from b where v not in (0, 255) group by all), d as (select e.scene_id, x.v, coalesce(n, 0) as n from e join range(256) x(v) on true left join h on h.scene_id = e.scene_id and h.v = x.v),
q as materialized (select scene_id, v, n, sum(n) over (partition by scene_id order by v) / (sum(n) over (partition by scene_id) + 1e-5) as q from d),
k as (select scene_id, {near(1e-6)} as valid0, {near(left)} as clip0, {near(1 - right)} as clip1, {near(1 - 1e-6)} as valid1 from q group by scene_id),
k2 as (select scene_id, low, greatest(valid0, low) as valid0, greatest(clip0, valid0, low) as clip0, least(clip1, high) as clip1, least(valid1, high) as valid1, high from e join k using (scene_id)),
w as (select *, {weight('low', 'valid0', 4.0, 0, 10)} as dark, {weight('valid0', 'clip0', 2.0, 10, 60)} as lft, {weight('clip0', 'clip1', 0.5, 100, 160)} as middle, {weight('clip1', 'valid1', 2.0, 10, 60)} as rgt, {weight('valid1', 'high', 4.0, 0, 10)} as white from k2),
w2 as (select scene_id, high, greatest(1.0e0, low) as low, greatest(valid0, greatest(1.0e0, low) + 1) as valid0, clip0, clip1, least(valid1, high - 1) as valid1, dark / (dark + lft + middle + rgt + white) as dark, lft / (dark + lft + middle + rgt + white) as lft,
 middle / (dark + lft + middle + rgt + white) as middle from w), w3 as (select * replace (greatest(clip0, valid0 + 1) as clip0, least(clip1, valid1 - 1) as clip1) from w2),
s0 as (select *, 0 as x, 0 as base, case when v < low then 1.0e0 else least(v, high) end as y from q join w3 using (scene_id)),
{stage(1, 'low', 'valid0', 'dark')}, {stage(2, 'valid0', 'clip0', 'lft')}, {stage(3, 'clip0', 'clip1', 'middle')},
t1 as (select * exclude (x, y, base), y as x, coalesce(max(case when v = clip1 - 1 then y end) over (partition by scene_id), 1.0e0) as base, v >= clip1 and v < high as top from s3),
t2 as (select *, sum(n) filter (top) over (partition by scene_id) * 0.02e0 as most from t1),
t3 as (select *, sum(greatest(n - most, 0)) filter (top) over (partition by scene_id) as excess, least(n, most) as h from t2), t4 as (select *, floor(excess / (high - clip1)) as more from t3),
t5 as (select * replace (excess - more * coalesce(count(*) filter (top and h < most - more) over (partition by scene_id), 0) as excess, case when h < most - more then h + more else h end as h) from t4),
t6 as (select * replace (excess - coalesce(sum(most - h) filter (top and h >= most - more and h < most) over (partition by scene_id), 0) as excess, case when h >= most - more and h < most then most else h end as h) from t5),
t7 as (select *, greatest(ceil(excess), 0) as spare, count(*) filter (top and h < most) over (partition by scene_id) as m, count(*) filter (top and h < most) over (partition by scene_id order by v) as j from t6),
t8 as (select * replace (case when not top then 0 when h < most then h + floor(j * spare / m) - floor((j - 1) * spare / m) else h end as h) from t7),
t9 as (select scene_id, v, case when top then floor((256 - base) * (sum(h) over (partition by scene_id order by v) / (sum(h) over (partition by scene_id) + 0.01e0)) + base) else x end as x from t8),
lut as (select scene_id, v, round(pow(x / mx, {gamma!r}) * mx) as z from (select scene_id, v, floor(least(greatest(x, 1), 255)) as x, max(floor(least(greatest(x, 1), 255))) over (partition by scene_id) as mx from t9)),
m0 as materialized (select scene_id, r, c, case when v <= 0 or (v < 10 and (r < 4 or r >= 60 or c < 4 or c >= 60)) then 1 else 0 end as m from b),
{around('m1', 'm0', 'min')}, {around('m2', 'm1', 'max')}, {around('m3', 'm2', 'max')}, {around('m4', 'm3', 'min')}
select b.scene_id, b.r, b.c, cast(case when m4.m = 1 then 0 else z end as int) as v from b join lut using (scene_id, v) join m4 using (scene_id, r, c)"""


@query("h22_segment_stretch", "v_cells", sql=_stretch_sql(0.02, 0.1, 0.9))
def segment_stretch(cells: DataFrame) -> DataFrame:
    return raster.segment_stretch(_band(cells), "scene_id", "v", 64, 64, edge=4, left=0.02, right=0.1, gamma=0.9)


_NEAR = "select k.scene_id, k.r + dy as r, k.c + dx as c, post_class as v from v_cells k, (values (0,0),(0,1),(1,0),(0,-1),(-1,0)) d(dy, dx)"


@query("h24_dilation", "v_cells", sql=f"with n as ({_NEAR}) select k.scene_id, k.r, k.c, max(n.v) as v from v_cells k join n on k.scene_id = n.scene_id and k.r = n.r and k.c = n.c group by all")
def dilation(cells: DataFrame) -> DataFrame:
    return raster.morphology(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), "scene_id", "v", "max", "cross")


@query("h24_erosion", "v_cells", sql=f"with n as ({_NEAR}) select k.scene_id, k.r, k.c, min(n.v) as v from v_cells k join n on k.scene_id = n.scene_id and k.r = n.r and k.c = n.c group by all")
def erosion(cells: DataFrame) -> DataFrame:
    return raster.morphology(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), "scene_id", "v", "min", "cross")


@query("h26_zero_padding", "v_cells", sql="""with g as (select s.scene_id, r, c from (select distinct scene_id from v_cells) s, range(0, 70) a(r), range(0, 70) b(c))
select g.scene_id, cast(g.r as bigint) as r, cast(g.c as bigint) as c, coalesce(k.pre_class, 0) as v from g left join v_cells k on g.scene_id = k.scene_id and g.r = k.r and g.c = k.c""")
def zero_padding(cells: DataFrame) -> DataFrame:
    return raster.padded(cells.select("scene_id", "r", "c", F.col("pre_class").alias("v")), "scene_id", "v", 70, 70)


@query("h26_mirror_padding", "v_cells", sql="""with g as (select s.scene_id, r, c, case when r >= 64 then 126 - r else r end as fr, case when c >= 64 then 126 - c else c end as fc
 from (select distinct scene_id from v_cells) s, range(0, 70) a(r), range(0, 70) b(c))
select g.scene_id, cast(g.r as bigint) as r, cast(g.c as bigint) as c, k.pre_class as v from g join v_cells k on g.scene_id = k.scene_id and g.fr = k.r and g.fc = k.c""")
def mirror_padding(cells: DataFrame) -> DataFrame:
    return raster.mirrored(cells.select("scene_id", "r", "c", F.col("pre_class").alias("v")), "scene_id", "v", 64, 64, 70, 70)


@query("h27_tile_index", "v_scene_files", sql="""with s as (select scene_key, 100 + scene_key % 400 as width, 100 + (scene_key * 7) % 300 as height from v_scene_files),
x as (select scene_key, width, height, unnest(range(0, greatest(width - 32, 1), 96)) as x from s), t as (select *, unnest(range(0, greatest(height - 32, 1), 96)) as y from x)
select scene_key, cast(x as bigint) as x, cast(y as bigint) as y, cast(case when x + 128 = width then -1 else greatest(x + 128 - width, 0) end as bigint) as pad_right,
 cast(case when y + 128 = height then -1 else greatest(y + 128 - height, 0) end as bigint) as pad_down from t""")
def tile_index(files: DataFrame) -> DataFrame:
    scenes = files.select("scene_key", (100 + F.col("scene_key") % 400).alias("width"), (100 + (F.col("scene_key") * 7) % 300).alias("height"))
    return raster.tile_index(scenes, ["scene_key"], size=128, overlap=32)


@query("h29_nearest_resample", "v_cells", sql="""with g as (select s.scene_id, r, c, cast(floor((r + 0.5) * 1.5) as bigint) as fr, cast(floor((c + 0.5) * 1.5) as bigint) as fc
 from (select distinct scene_id from v_cells) s, range(0, 42) a(r), range(0, 42) b(c))
select g.scene_id, cast(g.r as bigint) as r, cast(g.c as bigint) as c, coalesce(k.pre_class, 0) as v from g left join v_cells k on g.scene_id = k.scene_id and g.fr = k.r and g.fc = k.c""")
def nearest_resample(cells: DataFrame) -> DataFrame:
    return raster.nearest(cells.select("scene_id", "r", "c", F.col("pre_class").alias("v")), "scene_id", "v", 42, 42, 1.5)


@query("h30_bilinear_half", "v_cells", sql="""with g as (select s.scene_id, r, c, r * 63.0e0 / 31 as y, c * 63.0e0 / 31 as x from (select distinct scene_id from v_cells) s, range(0, 32) a(r), range(0, 32) b(c)),
n as (select g.scene_id, g.r, g.c, (1 - abs(y - (floor(y) + dy))) * (1 - abs(x - (floor(x) + dx))) as w, floor(y) + dy as fr, floor(x) + dx as fc from g, (values (0),(1)) a(dy), (values (0),(1)) b(dx))
select n.scene_id, cast(n.r as bigint) as r, cast(n.c as bigint) as c, round(sum(w * coalesce(k.pre_class, 0)), 6) as v from n left join v_cells k on n.scene_id = k.scene_id and n.fr = k.r and n.fc = k.c where w > 0 group by all""")
def bilinear_half(cells: DataFrame) -> DataFrame:
    half = raster.bilinear(cells.select("scene_id", "r", "c", F.col("pre_class").alias("v")), "scene_id", "v", 64, 64, 32, 32)
    return half.select("scene_id", "r", "c", F.round("v", 6).alias("v"))


_PATCHES = """with n as (select k.scene_id, k.r, k.c, least(greatest(k.r + dy, 0), 63) as fr, least(greatest(k.c + dx, 0), 63) as fc, dy, dx
 from v_cells k, (values (-1),(0),(1)) a(dy), (values (-1),(0),(1)) b(dx)) select n.scene_id, n.r, n.c, cast(sum(coalesce(k.post_class, 0)) as bigint) as total, count(k.post_class) as cells from n left join v_cells k on n.scene_id = k.scene_id and n.fr = k.r and n.fc = k.c group by all"""


@query("h42_patches", "v_cells", sql=_PATCHES)
@query("h42_all_patches", "v_cells", sql=_PATCHES)
def all_patches(cells: DataFrame) -> DataFrame:
    """The 3 x 3 window around each cell of every scene: its sum, and its cells with data."""
    return _patch_sums(cells)


def _patch_sums(cells: DataFrame) -> DataFrame:
    out = raster.patches(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), "scene_id", "v", 3, 64, 64)
    total = F.aggregate("patch", F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x["v"].cast("long"), F.lit(0).cast("long")))
    return out.select("scene_id", "r", "c", total.alias("total"), F.size(F.filter("patch", lambda x: x["v"].isNotNull())).cast("long").alias("cells"))


@query("h43_overviews", "v_cells", sql="select k.factor as factor, scene_id, cast(r // k.factor as bigint) as r, cast(c // k.factor as bigint) as c, post_class as v from v_cells, (values (2),(4),(8)) k(factor) where r % k.factor = 0 and c % k.factor = 0")
def overviews(cells: DataFrame) -> DataFrame:
    return raster.overviews(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), "v", [2, 4, 8])


@query("h47_mosaic", "v_cells", sql="select scene_id, r, c, post_class as v from v_cells")
def mosaic(cells: DataFrame) -> DataFrame:
    """Tiles with overlap, written back: every cell once, as it was."""
    tiles = raster.tiled(cells.select("scene_id", "r", "c", F.col("post_class").alias("v")), size=24, overlap=8, width=64, height=64)
    return raster.mosaic(tiles, size=24, overlap=8, width=64, height=64).select("scene_id", "r", "c", "v")


@query("j5_pixel_join", "v_cells", sql="select a.scene_id as scene_id, b.scene_id as other, count(*) as both, cast(sum(case when a.post_class = b.post_class then 1 else 0 end) as bigint) as equal_cells from v_cells a join v_cells b on a.r = b.r and a.c = b.c and b.scene_id = a.scene_id + 1 group by all")
def pixel_join(cells: DataFrame) -> DataFrame:
    return raster.stacked(cells, cells.withColumn("scene_id", F.col("scene_id") - 1)).groupBy("scene_id").agg(F.count("*").alias("both"), F.count_if(F.col("a.post_class") == F.col("b.post_class")).alias("equal_cells")).select("scene_id", (F.col("scene_id") + 1).alias("other"), "both", "equal_cells")


@query("c7_no_data_cells", "v_cells", sql="select scene_id, r, c, (pre_class * 16 * (post_class * 16)) % 256 = 0 as no_data from v_cells")
def no_data_cells(cells: DataFrame) -> DataFrame:
    from geoledger.functions.classes import no_data

    return cells.select("scene_id", "r", "c", no_data([F.col("pre_class") * 16], [F.col("post_class") * 16]).alias("no_data"))


@query("c9_skip_empty_tiles", "v_cells", sql="""with t as (select scene_id, r // 8 as tr, c // 8 as tc, max(case when pre_class * post_class % 7 = 3 then 1 else 0 end) as has_valid from v_cells group by all)
select k.scene_id, k.r, k.c, k.pre_class, k.post_class from v_cells k join t on k.scene_id = t.scene_id and k.r // 8 = t.tr and k.c // 8 = t.tc where has_valid = 1""")
def skip_empty_tiles(cells: DataFrame) -> DataFrame:
    return raster.without_empty_tiles(cells, 8, (F.col("pre_class") * F.col("post_class")) % 7 == 3)


@query("g7_dual_model_or", "v_cells", sql="select scene_id, r, c, case when pre_class % 3 = 0 or post_class % 4 = 1 then 1 else 0 end as change from v_cells")
def dual_model_or(cells: DataFrame) -> DataFrame:
    one = cells.select("scene_id", "r", "c", (F.col("pre_class") % 3 == 0).cast("int").alias("change"))
    two = cells.select("scene_id", "r", "c", (F.col("post_class") % 4 == 1).cast("int").alias("change"))
    return raster.fused(one, two)


@query("h44_colour_map", "v_cells", sql="select scene_id, r, c, (post_class * 37) % 256 as red, (post_class * 91) % 256 as green, (post_class * 151) % 256 as blue from v_cells")
def colour_map(cells: DataFrame) -> DataFrame:
    palette = cells.sparkSession.createDataFrame([(k, k * 37 % 256, k * 91 % 256, k * 151 % 256) for k in range(14)], "post_class int, red int, green int, blue int")
    return cells.join(F.broadcast(palette), "post_class").select("scene_id", "r", "c", "red", "green", "blue")


@query("h45_coarse_overlay", "v_cells", sql=f"select scene_id, r, c, case when post_class = 0 then pre_class else cast(floor((pre_class * 650 + {_MAJOR.format('post_class')} * 1400) / 100.0) as int) end as shade from v_cells")
def coarse_overlay(cells: DataFrame) -> DataFrame:
    blend = F.floor((F.col("pre_class") * 650 + major_class(F.col("post_class")) * 1400) / 100).cast("int")
    return cells.select("scene_id", "r", "c", F.when(F.col("post_class") == 0, F.col("pre_class")).otherwise(blend).alias("shade"))


@query("h51_run_lengths", "v_cells", sql="""with m as (select scene_id, r, c, c - row_number() over (partition by scene_id, r order by c) as g from v_cells where post_class > 7)
select scene_id, r, min(c) as c0, max(c) as c1, count(*) as n from m group by scene_id, r, g""")
def run_lengths(cells: DataFrame) -> DataFrame:
    return raster.runs(cells.where("post_class > 7").withColumn("v", F.lit(1)), ["scene_id"], "v").select("scene_id", "r", "c0", "c1", (F.col("c1") - F.col("c0") + 1).alias("n"))


_REGIONS = """with recursive m as (select scene_id, r, c, post_class % 3 as v, scene_id * 4096 + r * 64 + c as id from v_cells where post_class % 3 > 0),
w(id, root) as (select id, id from m union select n.id, w.root from w join m a on a.id = w.id join m n on n.scene_id = a.scene_id and n.v = a.v and abs(n.r - a.r) + abs(n.c - a.c) = 1 where w.root <= n.id)
select root // 4096 as scene_id, cast(root % 4096 as bigint) as label, count(*) as cells from (select id, min(root) as root from w group by id) group by root"""


@query("h38_components", "v_cells", sql=_REGIONS)
@query("h38_all_components", "v_cells", sql=_REGIONS)
def all_components(cells: DataFrame) -> DataFrame:
    """Sizes of the 4-connected regions of equal class of every scene, by their first cell."""
    return _component_sizes(cells)


def _component_sizes(cells: DataFrame) -> DataFrame:
    some = cells.where("post_class % 3 > 0").select("scene_id", "r", "c", (F.col("post_class") % 3).alias("v"))
    labels = raster.components(some, 64)
    return labels.groupBy("scene_id", "label").agg(F.count("*").alias("cells")).select("scene_id", F.col("label").cast("long").alias("label"), "cells")


@query("f6_largest_components", "v_cells")
def largest_components(cells: DataFrame) -> DataFrame:
    """The five regions of each scene with the longest outline; regions come from star contraction, checked by h38_all_components."""
    some = cells.select("scene_id", "r", "c", (F.col("post_class") % 3).alias("v")).where("v > 0")
    return raster.longest_outlines(raster.components(some, 64), 5)
