"""Queries over annotation data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.operators import annotations
from geoledger.plans.catalog import query


def _nested(anns: DataFrame) -> DataFrame:
    return annotations.nested(anns, "image_id", ["ann_no", "category_id", "iscrowd"])


@query("a13_nested_annotations", "v_anns", sql="select image_id, count(*) as n, cast(sum(category_id) as bigint) as categories from v_anns group by image_id")
def nested_annotations(anns: DataFrame) -> DataFrame:
    total = F.aggregate("annotations", F.lit(0).cast("long"), lambda s, a: s + a["category_id"])
    return _nested(anns).select("image_id", F.size("annotations").cast("long").alias("n"), total.alias("categories"))


@query("c17_without_crowd_only", "v_anns", sql="select image_id, count(*) as n from v_anns group by image_id having min(iscrowd) = 0")
def without_crowd_only(anns: DataFrame) -> DataFrame:
    return annotations.without_crowd_only(_nested(anns)).select("image_id", F.size("annotations").cast("long").alias("n"))


@query("c18_visible_keypoints", "v_boxes", sql="select image_id from v_boxes group by image_id having sum(case when box_id % 3 > 0 then 1 else 0 end + case when category_id > 2 then 1 else 0 end) >= 20")
def visible_keypoints(boxes: DataFrame) -> DataFrame:
    x, y = F.col("x0"), F.col("y0")
    points = F.array(x, y, (F.col("box_id") % 3).cast("double"), x, y, F.when(F.col("category_id") > 2, 1.0).otherwise(0.0))
    held = annotations.nested(boxes.withColumn("keypoints", points), "image_id", ["box_id", "keypoints"])
    return annotations.with_visible_keypoints(held, 20).select("image_id")


@query("c21_category_whitelist", "v_anns", sql="select image_id, count(*) filter (where category_id < 40 and category_id % 2 = 0) as n, coalesce(cast(sum(case when category_id < 40 and category_id % 2 = 0 then category_id // 2 end) as bigint), 0) as total from v_anns group by image_id")
def category_whitelist(anns: DataFrame) -> DataFrame:
    out = annotations.remapped(_nested(anns), {k: k // 2 for k in range(0, 40, 2)})
    total = F.aggregate("annotations", F.lit(0).cast("long"), lambda s, a: s + a["category_id"])
    return out.select("image_id", F.size("annotations").cast("long").alias("n"), total.alias("total"))


@query("c22_contiguous_ids", "v_anns", sql="select category_id * 3 + 7 as category_id, dense_rank() over (order by category_id) - 1 as contiguous from (select distinct category_id from v_anns)")
def contiguous_ids(anns: DataFrame) -> DataFrame:
    return annotations.contiguous(anns.select((F.col("category_id") * 3 + 7).alias("category_id")), "category_id")


@query("d13_class_instances", "v_anns", sql="select category_id, count(*) filter (where iscrowd = 0) as n from v_anns group by grouping sets ((category_id), ())")
def class_instances(anns: DataFrame) -> DataFrame:
    return anns.groupingSets([["category_id"], []], "category_id").agg(F.count_if(F.col("iscrowd") == 0).alias("n")).select("category_id", "n")


@query("d14_category_frequency", "v_anns", sql="select category_id, round(count(distinct image_id) * 1.0e0 / (select count(distinct image_id) from v_anns), 9) as f from v_anns group by category_id")
def category_frequency(anns: DataFrame) -> DataFrame:
    return annotations.frequencies(anns).select("category_id", F.round("f", 9).alias("f"))


_FACTOR = """with n as (select count(distinct image_id) as n from v_anns), f as (select category_id, count(distinct image_id) * 1.0e0 / any_value(n) as f from v_anns, n group by category_id), r as (select category_id, greatest(1, sqrt(0.02 / f)) as r from f)"""


@query("d15_repeat_factors", "v_anns", sql=f"{_FACTOR} select image_id, round(max(r), 6) as factor from v_anns join r using (category_id) group by image_id")
def repeat_factors(anns: DataFrame) -> DataFrame:
    return annotations.repeat_factors(anns, 0.02).select("image_id", F.round("factor", 6).alias("factor"))


@query("d16_weighted_factors", "v_anns", sql=f"{_FACTOR}, m as (select image_id, max(r) * (1 + image_id % 3) as w from v_anns join r using (category_id) group by image_id) select image_id, round(w / (select min(w) from m), 6) as weight from m")
def weighted_factors(anns: DataFrame) -> DataFrame:
    return annotations.weighted(annotations.repeat_factors(anns, 0.02), 1 + F.col("image_id") % 3).select("image_id", F.round("weight", 6).alias("weight"))


@query("d17_frequency_weights", "v_anns", sql="select category_id, round(pow(count(distinct image_id), 0.5), 6) as weight from v_anns group by category_id")
def frequency_weights(anns: DataFrame) -> DataFrame:
    return annotations.frequency_weights(anns, 0.5).select("category_id", F.round("weight", 6).alias("weight"))


@query("g8_combined_datasets", "v_anns", sql="select category_id % 40 as category_id, count(distinct category_id) as names from v_anns group by category_id % 40 having count(distinct category_id) > 1")
def combined_datasets(anns: DataFrame) -> DataFrame:
    """Categories that two data sets name differently."""
    named = anns.select((F.col("category_id") % 40).alias("category_id"), F.concat(F.lit("n"), F.col("category_id").cast("string")).alias("name"))
    return annotations.name_conflicts(named)


@query("c28_metadata_consistency", "v_anns", sql="select image_id % 5 as dataset, count(distinct iscrowd) = 1 as same from v_anns group by all")
def metadata_consistency(anns: DataFrame) -> DataFrame:
    return anns.groupBy((F.col("image_id") % 5).alias("dataset")).agg((F.count_distinct("iscrowd") == 1).alias("same"))


@query("j16_merged_records", "v_anns", sql="with d as (select image_id, count(*) as dets from v_anns where iscrowd = 0 group by image_id), s as (select image_id, max(category_id) as sem from v_anns group by image_id) select image_id, dets, sem from d join s using (image_id)")
def merged_records(anns: DataFrame) -> DataFrame:
    dets = anns.where("iscrowd = 0").groupBy("image_id").agg(F.count("*").alias("dets"), F.lit(-1).cast("long").alias("sem"))
    sems = anns.groupBy("image_id").agg(F.max("category_id").alias("sem"))
    return annotations.overridden(dets, sems, "image_id").select("image_id", "dets", "sem")


@query("h17_transformed", "v_boxes", sql="select box_id, least(greatest(200 - x1, 0), 200) as x0, least(greatest(y0, 0), 150) as y0, least(greatest(200 - x0, 0), 200) as x1, least(greatest(y1, 0), 150) as y1 from v_boxes")
def transformed(boxes: DataFrame) -> DataFrame:
    return annotations.flipped(boxes, 200, 150).select("box_id", "x0", "y0", "x1", "y1")
