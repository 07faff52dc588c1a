"""Queries over scene files, runs and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.operators import runs
from geoledger.plans.catalog import query


@query("j1_scene_pairs", "v_scene_files", sql="select stem, concat('pre/', stem, '.tif') as pre_path, concat('post/', stem, '.tiff') as post_path from v_scene_files where has_pre = 1 and has_post = 1")
def scene_pairs(files: DataFrame) -> DataFrame:
    path = lambda folder, suffix: F.concat(F.lit(folder), F.col("stem"), F.lit(suffix)).alias("path")
    pre = files.where("has_pre = 1")
    both = pre.select("stem", path("pre/", ".tif")).unionByName(pre.select("stem", path("pre/", ".tiff")))
    return runs.paired(both, files.where("has_post = 1").select("stem", path("post/", ".tiff")))


@query("g4_unmatched_scenes", "v_scene_files", sql="select stem from v_scene_files where has_pre = 1 and has_post = 0")
def unmatched_scenes(files: DataFrame) -> DataFrame:
    return runs.unmatched(files.where("has_pre = 1").select("stem"), files.where("has_post = 1").select("stem"), "stem")


@query("j2_missing_parts", "v_scene_files", sql="select stem, array_to_string(list_filter([case when has_pre = 0 then 'pre' end, case when has_post = 0 then 'post' end, case when has_vector = 0 then 'mask' end], lambda x: x is not null), ',') as missing from v_scene_files where has_vector = 0 or has_pre = 0 or has_post = 0")
def missing_parts(files: DataFrame) -> DataFrame:
    some = runs.with_missing(files, {"pre": F.col("has_pre") == 1, "post": F.col("has_post") == 1, "mask": F.col("has_vector") == 1})
    return some.where(F.size("missing") > 0).select("stem", F.concat_ws(",", "missing").alias("missing"))


_GRIDS = "select o_orderkey as k, o_orderkey % 100 * 2.0e0 as a_x, o_orderkey % 50 * 2.0e0 as a_y, o_custkey % 120 * 2.0e0 as b_x, o_custkey % 90 * 2.0e0 as b_y, 40 as width, 30 as height from orders"


def _grids(orders: DataFrame) -> DataFrame:
    two = lambda c, n: (F.col(c) % n * 2.0)
    return orders.select(F.col("o_orderkey").alias("k"), two("o_orderkey", 100).alias("a_x"), two("o_orderkey", 50).alias("a_y"), two("o_custkey", 120).alias("b_x"), two("o_custkey", 90).alias("b_y"), F.lit(2.0).alias("res"), *[F.lit(n).alias(f"{s}_{c}") for s in "ab" for c, n in (("width", 40), ("height", 30))])


@query("j3_overlap_windows", "orders", sql=f"""with g as ({_GRIDS}), o as (select k, a_x, a_y, b_x, b_y, cast(trunc((least(a_x, b_x) + 80 - greatest(a_x, b_x)) / 2) as int) as cols, cast(trunc((least(a_y, b_y) + 60 - greatest(a_y, b_y)) / 2) as int) as rows from g)
select k, case when cols > 0 and rows > 0 then cast((greatest(a_x, b_x) - a_x) / 2 as int) end as a_col, case when cols > 0 and rows > 0 then cast((greatest(a_y, b_y) - b_y) / 2 as int) end as b_row,
 case when cols > 0 and rows > 0 then cols end as cols, case when cols > 0 and rows > 0 then rows end as rows from o""")
def overlap_windows(orders: DataFrame) -> DataFrame:
    return runs.overlap_window(_grids(orders), "width", "height").select("k", "a_col", "b_row", "cols", "rows")


@query("j4_alignment", "orders", sql=f"with g as ({_GRIDS}) select k, case when k % 3 = 0 then 'resample' when a_x = b_x and a_y = b_y then 'as is' else 'crop' end as how from g")
def alignment(orders: DataFrame) -> DataFrame:
    same = (F.col("a_x") == F.col("b_x")) & (F.col("a_y") == F.col("b_y"))
    res = F.when(F.col("k") % 3 == 0, 4.0).otherwise(2.0)
    return _grids(orders).select("k", runs.alignment(same, F.abs(res - F.col("res")) < 1e-8).alias("how"))


@query("j17_resume", "v_scene_files", sql="select stem, case when has_pre = 0 then 'no record' when scene_key % 7 = 0 then 'identity differs' when scene_key % 5 = 0 then 'result differs' else 'resumed' end as reason from v_scene_files")
def resume(files: DataFrame) -> DataFrame:
    tasks = files.select("stem", F.lit("m1").alias("identity"), F.sha2("stem", 256).alias("digest"))
    records = files.where("has_pre = 1").select("stem", F.when(F.col("scene_key") % 7 == 0, "m0").otherwise("m1").alias("identity"), F.when(F.col("scene_key") % 5 == 0, "x").otherwise(F.sha2("stem", 256)).alias("digest"))
    return runs.resumed(tasks, records).select("stem", "reason")


@query("j18_reviewed_transitions", "v_scene_files", sql="select stem, concat('a', cast(scene_key % 6 as varchar)) as algorithm from v_scene_files where scene_key % 6 in (5, 3, 4)")
def reviewed_transitions(files: DataFrame) -> DataFrame:
    allowed = files.sparkSession.createDataFrame([("a5", "a3"), ("a5", "a4"), ("a2", "a1")], "current string, older string")
    return runs.accepted(files.select("stem", F.concat(F.lit("a"), (F.col("scene_key") % 6).cast("string")).alias("algorithm")), "a5", allowed)


_LINES = """select cast(task as varchar) as file, cur as line_no, ts, case when cur % 5 = 1 then concat('Processing (', cast(cur as varchar), '/', cast(total as varchar), ') on GPU: pre=p', cast(cur as varchar), '.tif, post=q', cast(cur % 7 as varchar), '.tif -> out', cast(cur % 7 as varchar), '.shp')
 when status = 'purchase' then 'success' else status end as value from v_progress"""


def _lines(progress: DataFrame) -> DataFrame:
    header = F.format_string("Processing (%d/%d) on GPU: pre=p%d.tif, post=q%d.tif -> out%d.shp", "cur", "total", "cur", F.col("cur") % 7, F.col("cur") % 7)
    line = F.when(F.col("cur") % 5 == 1, header).when(F.col("status") == "purchase", "success").otherwise(F.col("status"))
    return progress.select(F.col("task").cast("string").alias("file"), F.col("cur").alias("line_no"), "ts", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" "), line).alias("value"))


@query("j19_h2_log_headers", "v_progress", sql=f"""with l as ({_LINES}) select file, line_no, concat('q', cast((((line_no - 1) // 5) * 5 + 1) % 7 as varchar), '.tif') as post, cast(((line_no - 1) // 5) * 5 + 1 as varchar) as idx from l""")
def log_headers(progress: DataFrame) -> DataFrame:
    return runs.log_attempts(_lines(progress)).select("file", "line_no", F.col("attempt.post").alias("post"), F.col("attempt.index").alias("idx"))


@query("e6_latest_attempts", "v_progress", sql=f"""with l as ({_LINES}), a as (select file, ((line_no - 1) // 5) * 5 + 1 as first_line, min(ts) as ts, max(case when value = 'success' then 1 else 0 end) as ok from l group by all),
k as (select concat('out', cast(first_line % 7 as varchar), '.shp') as stem, file, first_line, ok, row_number() over (partition by first_line % 7 order by date_trunc('millisecond', ts) desc, file, first_line desc) as k from a)
select stem, file, first_line, ok = 1 as done from k where k = 1""")
def latest_attempts(progress: DataFrame) -> DataFrame:
    lines = runs.log_attempts(_lines(progress))
    attempts = lines.groupBy("file", F.col("attempt.first_line").alias("line_no"), F.col("attempt.result").alias("stem")).agg(F.min("time").alias("time"), F.bool_or(F.col("value").endswith(" success")).alias("done"))
    return runs.latest_attempts(attempts).select("stem", "file", F.col("line_no").alias("first_line"), "done")


@query("j20_latest_items", "orders", sql="select o_custkey, coalesce(arg_max(concat('item', cast(o_orderkey as varchar)), (o_orderdate, o_orderkey)) filter (where o_orderstatus = 'F'), 'default') as path from orders group by o_custkey")
def latest_items(orders: DataFrame) -> DataFrame:
    items = orders.select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("item"), F.col("o_orderkey").cast("string"))).alias("path"), F.struct("o_orderdate", "o_orderkey").alias("released"))
    return runs.latest_item(items, ["o_custkey"], "path", "released", "default")


@query("d10_feature_counts", "v_scene_files", "v_polygons", sql="select s.scene_key, count(p.fid) as features from v_scene_files s left join v_polygons p on p.scene_id = s.scene_key % 20 group by s.scene_key")
def feature_counts(files: DataFrame, polygons: DataFrame) -> DataFrame:
    counts = polygons.groupBy("scene_id").agg(F.count("*").alias("features"))
    return files.withColumn("scene_id", F.col("scene_key") % 20).join(counts, "scene_id", "left").select("scene_key", F.coalesce("features", F.lit(0).cast("long")).alias("features"))


@query("d12_b5_batch_outcome", "v_scene_files", sql="""with s as (select case when scene_key % 11 = 0 then 'failed' when scene_key % 13 = 0 then 'empty' when has_pre = 1 then 'resumed' else 'new' end as s from v_scene_files)
select count(*) filter (where s <> 'failed') as processed, count(*) filter (where s = 'resumed') as resumed, count(*) filter (where s = 'new') as fresh, count(*) filter (where s = 'failed') as failed, count(*) filter (where s = 'empty') as empty, 'completed_with_warnings' as status from s""")
def batch_outcome(files: DataFrame) -> DataFrame:
    status = F.when(F.col("scene_key") % 11 == 0, "failed").when(F.col("scene_key") % 13 == 0, "empty").when(F.col("has_pre") == 1, "resumed").otherwise("new")
    return runs.outcome(files.select(status.alias("status")))


@query("d31_distinct_names", "v_scene_files", sql="select count(distinct split_part(stem, '_', 3)) as years from v_scene_files")
def distinct_names(files: DataFrame) -> DataFrame:
    return files.select(F.element_at(F.split("stem", "_"), 3).alias("y")).distinct().agg(F.count("*").alias("years"))


@query("d32_fingerprints", "v_scene_files", sql="select scene_key % 50 as run, sha256(string_agg(concat(stem, '|', cast(scene_key * 3 as varchar), '|', cast(has_pre as varchar)), chr(10) order by concat(stem, '|', cast(scene_key * 3 as varchar), '|', cast(has_pre as varchar)))) as fingerprint from v_scene_files group by all")
def fingerprints(files: DataFrame) -> DataFrame:
    listed = files.select((F.col("scene_key") % 50).alias("run"), F.col("stem").alias("path"), (F.col("scene_key") * 3).alias("size"), F.col("has_pre").alias("mtime"))
    return runs.fingerprint(listed, ["run"])


@query("k11_completeness", "v_scene_files", sql="select count(*) = 0 as complete, count(*) as waiting from v_scene_files where has_post = 0")
def completeness(files: DataFrame) -> DataFrame:
    return runs.complete(files.select("stem"), files.where("has_post = 1").select("stem"), "stem")


@query("g3_common_names", "v_scene_files", sql="select stem from v_scene_files where has_pre = 1 and has_vector = 1")
def common_names(files: DataFrame) -> DataFrame:
    return files.where("has_pre = 1").select("stem").intersect(files.where("has_vector = 1").select("stem"))


@query("g5_first_per_name", "orders", sql="select o_custkey, concat('/d', cast(min(o_orderkey) as varchar)) as path from orders group by o_custkey")
def first_per_name(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(F.min_by(F.concat(F.lit("/d"), F.col("o_orderkey").cast("string")), "o_orderkey").alias("path"))


@query("d27_e9_stage_timing", "v_progress", sql="""with r as (select task, cur, value, ts, cur - lag(cur) over w as step, date_diff('microsecond', lag(ts) over w, ts) / 1.0e6 as secs from v_progress window w as (partition by task order by cur))
select task, count(*) as reports, round(sum(value), 4) as wait, round(sum(step) / sum(secs), 9) as rate from r where cur > 5 group by task""")
def stage_timing(progress: DataFrame) -> DataFrame:
    """Totals of each task without the first five reports, and the rate between reports."""
    w = Window.partitionBy("task").orderBy("cur")
    secs = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))) / 1e6
    r = progress.withColumns({"step": F.col("cur") - F.lag("cur").over(w), "secs": secs}).where("cur > 5")
    return r.groupBy("task").agg(F.count("*").alias("reports"), F.round(F.sum("value"), 4).alias("wait"), F.round(F.sum("step") / F.sum("secs"), 9).alias("rate"))


@query("e8_row_ids", "v_polygons", sql="select scene_id, fid, row_number() over (partition by scene_id order by fid) - 1 as uid from v_polygons")
def row_ids(polygons: DataFrame) -> DataFrame:
    return polygons.select("scene_id", "fid", (F.row_number().over(Window.partitionBy("scene_id").orderBy("fid")) - 1).cast("long").alias("uid"))


@query("b4_manifest", "v_scene_files", sql="select scene_key % 20 as dataset, count(*) as files, min(stem) as first, max(stem) as last from v_scene_files group by all")
def manifest(files: DataFrame) -> DataFrame:
    grouped = files.groupBy((F.col("scene_key") % 20).alias("dataset")).agg(F.sort_array(F.collect_list("stem")).alias("file"))
    return grouped.select("dataset", F.size("file").cast("long").alias("files"), F.col("file")[0].alias("first"), F.element_at("file", -1).alias("last"))


@query("b7_latest_records", "orders", sql="select o_custkey, max(o_orderkey) as version, arg_max(o_orderstatus, o_orderkey) as status from orders group by o_custkey")
def latest_records(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("version"), F.max_by("o_orderstatus", "o_orderkey").alias("status"))


@query("c27_verified_results", "v_scalars", sql="with a as (select name, avg(value) as v, count(*) as n from v_scalars group by name) select name, abs(v - 25) <= 10 and n > 0 as ok from a")
def verified_results(scalars: DataFrame) -> DataFrame:
    actual = scalars.groupBy("name").agg(F.avg("value").alias("v"))
    expected = scalars.select("name").distinct().withColumns({"expected": F.lit(25.0), "tolerance": F.lit(10.0)})
    ok = F.coalesce((F.abs(F.col("v") - F.col("expected")) <= F.col("tolerance")) & ~F.isnan("v"), F.lit(False))
    return expected.join(actual, "name", "left").select("name", ok.alias("ok"))
