"""Queries of scalar functions over scene files, events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions import classes, text
from geoledger.plans.catalog import query

_CODE = "cast(l_quantity as int)"


@query("c2_class_remap", "lineitem", sql=f"select code, case when code in (1,2) then 1 when code in (3,4) then 2 when code = 5 then 3 when code = 11 then 4 when code between 6 and 9 then 5 when code in (10,12,13) then 6 else 0 end as major, count(*) as n from (select {_CODE} as code from lineitem) group by all")
def class_remap(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_quantity").cast("int").alias("code")).groupBy("code", classes.major_class(F.col("code")).alias("major")).agg(F.count("*").alias("n"))


@query("c3_class_remap_31", "lineitem", sql=f"select code, case when code in (1,2) then 1 when code between 3 and 13 then 2 when code between 14 and 17 then 3 when code in (25,30) then 4 when code between 18 and 24 or code in (26,28,29) then 5 when code = 27 then 6 else 0 end as major, count(*) as n from (select {_CODE} as code from lineitem) group by all")
def class_remap_31(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_quantity").cast("int").alias("code")).groupBy("code", classes.major_class_31(F.col("code")).alias("major")).agg(F.count("*").alias("n"))


@query("c4_land_use_collapse", "lineitem", sql=f"select code, case when code between 111 and 115 then 11 when code between 121 and 125 then 12 else code end as collapsed, count(*) as n from (select 90 + {_CODE} as code from lineitem) group by all")
def land_use_collapse(lineitem: DataFrame) -> DataFrame:
    coded = lineitem.select((F.col("l_quantity").cast("int") + 90).alias("code"))
    return coded.groupBy("code", classes.collapsed_land_use(F.col("code")).alias("collapsed")).agg(F.count("*").alias("n"))


@query("c5_class_names", "part", sql="select p_partkey, case p_size % 9 when 1 then 'cropland' when 2 then 'woodland' when 3 then 'grassland' when 4 then 'water' when 5 then 'built-up' when 6 then 'bare land' else 'unknown' end as name from part")
def class_names(part: DataFrame) -> DataFrame:
    code = F.when(F.col("p_size") % 9 == 8, "x").otherwise((F.col("p_size") % 9).cast("string"))
    return part.select("p_partkey", classes.class_name(code).alias("name"))


@query("c15_c16_class_filters", "v_cells", sql="select scene_id, r, c, case when post_class = 5 then 5 else 0 end as kept, lpad(cast(post_class as varchar), 2, '0') = '07' as padded, case when post_class in (3, 4, 8) then 3 else 0 end as forced, case when post_class = 1 then 9 else 0 end as foreground from v_cells")
def class_filters(cells: DataFrame) -> DataFrame:
    c = F.col("post_class")
    return cells.select("scene_id", "r", "c", classes.kept_class(c, 5).alias("kept"), classes.has_padded_code(c, "07").alias("padded"), classes.forced_class(c, [3, 4, 8]).alias("forced"), classes.forced_class(c, 1, foreground=9).alias("foreground"))


@query("c8_exception_mask", "v_cells", sql="select scene_id, r, c, coalesce(pre_class = 3 and post_class = 3, false) as invalid from v_cells")
def exception_mask(cells: DataFrame) -> DataFrame:
    return cells.select("scene_id", "r", "c", classes.has_value_in_all([F.col("pre_class"), F.col("post_class")], 3).alias("invalid"))


@query("c13_binary_threshold", "events", sql="select event_id, cast(round_even(1 / (1 + exp(-(value - 20) / 10)), 0) as int) as change from events")
def binary_threshold(events: DataFrame) -> DataFrame:
    return events.select("event_id", classes.binary_mask((F.col("value") - 20) / 10).alias("change"))


@query("c14_best_class", "embeddings", sql="select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as cls from embeddings")
def best_class(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("vec_id", classes.best_class(F.col("embedding")).alias("cls"))


@query("h11_softmax", "embeddings", sql="select vec_id, round(exp(embedding[1]::double - m) / list_sum(list_transform(embedding, lambda x: exp(x::double - m))), 5) as first from (select vec_id, embedding, list_max(embedding)::double as m from embeddings)")
def softmax(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("vec_id", F.round(classes.softmax(F.col("embedding").cast("array<double>"))[0], 5).alias("first"))


@query("c24_booleans", "orders", sql="select o_orderkey, case o_orderstatus when 'O' then true when 'F' then false else null end as flag from orders")
def booleans(orders: DataFrame) -> DataFrame:
    word = F.when(F.col("o_orderstatus") == "O", " Yes ").when(F.col("o_orderstatus") == "F", "OFF")
    return orders.select("o_orderkey", classes.as_bool(word).alias("flag"))


@query("c25_harmless_errors", "orders", sql="select o_orderkey, lower(o_orderpriority) like '%urgent%' or lower(o_orderpriority) like '%low%' as harmless from orders")
def harmless_errors(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", classes.is_harmless(F.col("o_orderpriority"), ["URGENT", "low"]).alias("harmless"))


@query("h10_clamped", "orders", sql="select o_orderkey, case when o_orderstatus = 'P' then 8.0e0 else greatest(least(try_cast(substr(o_orderpriority, 1, 1) as double), 4), 2) end as batch from orders")
def clamped(orders: DataFrame) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "P", "many").otherwise(F.substring("o_orderpriority", 1, 1))
    return orders.select("o_orderkey", classes.clamped(raw, 2, 4, 8).alias("batch"))


@query("c23_config_precedence", "v_scene_files", sql="select scene_key, case when has_vector = 1 then 2 + scene_key % 7 when has_pre = 1 then 3 when has_post = 1 then 5 else 4 end as batch from v_scene_files")
def config_precedence(files: DataFrame) -> DataFrame:
    from geoledger.operators.runs import setting

    layers = [F.when(F.col("has_vector") == 1, (2 + F.col("scene_key") % 7).cast("string")), F.when(F.col("has_pre") == 1, "3"), F.when(F.col("has_post") == 1, "5")]
    return files.select("scene_key", setting(layers, "4", 1, 32).cast("long").alias("batch"))


@query("h1_path_parts", "v_scene_files", sql="select scene_key, concat(stem, '.v2.tif') as name, concat(stem, '.v2') as stem, '.tif' as suffix, concat('/data/', cast(scene_key % 9 as varchar)) as parent, stem as token from v_scene_files")
def path_parts(files: DataFrame) -> DataFrame:
    path = F.concat(F.lit("/data/"), (F.col("scene_key") % 9).cast("string"), F.lit("/"), F.col("stem"), F.lit(".v2.tif"))
    return files.select("scene_key", text.file_name(path).alias("name"), text.stem(path).alias("stem"), text.suffix(path).alias("suffix"), text.parent(path).alias("parent"), text.first_token(path).alias("token"))


@query("g9_years_in_names", "v_scene_files", sql="select scene_key, case when scene_key % 10 = 0 then 0 else cast(split_part(stem, '_', 3) as int) end as curryear, case when scene_key % 10 = 0 then 0 else cast(split_part(stem, '_', 3) as int) end - 1 as preyear from v_scene_files")
def years_in_names(files: DataFrame) -> DataFrame:
    name = F.when(F.col("scene_key") % 10 == 0, "GF_none_1.tif").otherwise(F.concat(F.lit("GF_"), F.element_at(F.split("stem", "_"), 3), F.lit("_1.tif")))
    year = text.year_in_name(name)
    return files.select("scene_key", year.alias("curryear"), (year - 1).alias("preyear"))


@query("h3_year_and_region", "v_scene_files", sql="select scene_key, case when scene_key % 3 = 0 then 2024 else cast(split_part(stem, '_', 3) as int) + 10 end as year, case scene_key % 4 when 0 then '110000' when 1 then '440000' when 2 then '510000' else '440000' end as region from v_scene_files")
def year_and_region(files: DataFrame) -> DataFrame:
    year = F.when(F.col("scene_key") % 3 == 0, "99").otherwise((F.element_at(F.split("stem", "_"), 3).cast("int") + 10).cast("string"))
    place = F.element_at(F.array(*[F.lit(x) for x in ("north", "south", "west", "none")]), (F.col("scene_key") % 4 + 1).cast("int"))
    path = F.concat_ws("/", F.lit(""), place, year, F.col("stem"))
    return files.select("scene_key", text.year_in_path(path).alias("year"), text.region_in_path(path, {"north": "110000", "south": "440000", "west": "510000"}).alias("region"))


@query("h4_result_names", "v_scene_files", sql="select scene_key, concat('output_', stem, '_pre_', cast(scene_key % 30 as varchar), '.shp') as name from v_scene_files")
def result_names(files: DataFrame) -> DataFrame:
    return files.select("scene_key", text.result_name(F.col("stem"), F.lit("pre"), (F.col("scene_key") % 30).cast("string")).alias("name"))


@query("h5_json", "events", sql="select event_id, cast(props->>'k' as int) as k, concat('{\"k\":', props->>'k', ',\"type\":\"', event_type, '\"}') as again from events")
def json(events: DataFrame) -> DataFrame:
    parsed = events.select("event_id", F.from_json("props", "k int").alias("p"), "event_type")
    return parsed.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("p.k").alias("k"), F.col("event_type").alias("type"))).alias("again"))


@query("h6_durations", "events", sql="""with s as (select event_id, cast(floor(greatest(value * 100 - 500, 0)) as bigint) as s from events)
select event_id, case when s // 3600 > 0 then concat(s // 3600, 'h', s // 60 % 60, 'm', s % 60, 's') when s // 60 > 0 then concat(s // 60, 'm', s % 60, 's') else concat(s, 's') end as duration from s""")
def durations(events: DataFrame) -> DataFrame:
    return events.select("event_id", text.duration_text(F.col("value") * 100 - 500).alias("duration"))


@query("h7_sizes", "orders", sql="""with s as (select o_orderkey, cast(floor(o_totalprice) as bigint) * (o_orderkey % 5000 + 1) as b from orders) select o_orderkey, case when b < 1024 then printf('%.1f B', b::double) when b < 1048576 then printf('%.1f KB', round(b / 1024.0e0, 1))
 when b < 1073741824 then printf('%.1f MB', round(b / 1048576.0e0, 1)) when b < 1099511627776 then printf('%.1f GB', round(b / 1073741824.0e0, 1)) else printf('%.1f TB', round(b / 1099511627776.0e0, 1)) end as size from s""")
def sizes(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", text.size_text(F.floor("o_totalprice") * (F.col("o_orderkey") % 5000 + 1)).alias("size"))


@query("h8_timestamps", "events", sql="select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as sent, ts = ts as parsed_back from events")
def timestamps(events: DataFrame) -> DataFrame:
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - INFO - started"))
    back = F.date_trunc("millisecond", "ts") == text.log_time(line)
    return events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sent"), back.alias("parsed_back"))


@query("h9_progress_values", "v_progress", sql="select task, cur, cast(cur * 1.0e0 / total * 90 + 5 as double) as exact, cast(trunc(cur * 1.0e0 / total * 90 + 5) as int) as progress from v_progress")
def progress_values(progress: DataFrame) -> DataFrame:
    return progress.select("task", "cur", (F.col("cur") / F.col("total") * 90 + 5).alias("exact"), text.progress_value(F.col("cur"), F.col("total"), 5, 95).alias("progress"))


@query("h12_hash_ranks", "orders", sql="select o_orderkey, cast(concat('0x', substr(sha256(cast(o_orderkey as varchar)), 1, 15)) as bigint) as rank, sha256(o_orderpriority) as digest from orders")
def hash_ranks(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", text.hash_rank(F.col("o_orderkey").cast("string")).alias("rank"), F.sha2("o_orderpriority", 256).alias("digest"))


@query("h13_message_keys", "events", sql="select event_id, concat('[\"status\",\"value\"]') as keys, concat('{\"status\":\"', event_type, '\",\"value\":\"', cast(user_id as varchar), '\"}') as content from events")
def message_keys(events: DataFrame) -> DataFrame:
    content = F.create_map(F.lit("status"), F.col("event_type"), F.lit("value"), F.col("user_id").cast("string"))
    return events.select("event_id", F.to_json(F.map_keys(content)).alias("keys"), F.to_json(content).alias("content"))


@query("h18_flattened", "events", sql="select event_id, k as name, v as value from (select event_id, unnest(['run/task', 'run/value']) as k, unnest([cast(user_id as double), value]) as v from events)")
def flattened(events: DataFrame) -> DataFrame:
    nested = F.create_map(F.lit("run"), F.create_map(F.lit("task"), F.col("user_id").cast("double"), F.lit("value"), F.col("value")))
    outer = events.select("event_id", F.explode(nested).alias("k1", "inner"))
    return outer.select("event_id", "k1", F.explode("inner").alias("k2", "value")).select("event_id", F.concat_ws("/", "k1", "k2").alias("name"), "value")


@query("h49_panoptic_ids", "v_anns", sql="select image_id, ann_no, category_id * 1000 + ann_no as id, category_id as category_back, ann_no as instance_back, count(*) as n from v_anns group by all")
def panoptic_ids(anns: DataFrame) -> DataFrame:
    coded = anns.withColumn("id", F.col("category_id") * 1000 + F.col("ann_no"))
    return coded.select("image_id", "ann_no", "id", F.floor(F.col("id") / 1000).cast("long").alias("category_back"), (F.col("id") % 1000).cast("int").alias("instance_back")).groupBy("image_id", "ann_no", "id", "category_back", "instance_back").agg(F.count("*").alias("n"))


@query("h53_file_attributes", "v_polygons", sql="select fid, case when fid % 2 = 0 then 'own.tif' else 'pre.tif' end as pre_file, 'post.tif' as post_file, 0 as pre_code, 0 as curr_code from v_polygons")
def file_attributes(polygons: DataFrame) -> DataFrame:
    from geoledger.operators.runs import with_files

    return with_files(polygons.select("fid", F.when(F.col("fid") % 2 == 0, "own.tif").alias("pre_file")), "pre.tif", "post.tif")
