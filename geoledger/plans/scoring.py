"""Queries that score, and that work on whole tiles, videos or pairs in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions.classes import best_class
from geoledger.operators import scoring
from geoledger.plans.catalog import query


def _linear():  # noqa: ANN202
    """A stand-in for a user's network: ten class scores by a fixed linear map of the vector."""
    weights = np.cos(np.arange(640, dtype=np.float64)).reshape(64, 10)
    return lambda x: (np.asarray(x, np.float64).reshape(-1, 64) @ weights).astype(np.float32)


@query("u1_model_scores", "embeddings")
def model_scores(embeddings: DataFrame) -> DataFrame:
    scored = scoring.scored(embeddings.select("vec_id", "embedding"), "embedding", _linear, [64], batch=32)
    return scored.select("vec_id", best_class(F.col("scores")).alias("cls"))


@query("u2_two_model_change", "events", sql="select event_id, case when value > 20 or user_id % 50 > 25 then 1 else 0 end as change from events")
def two_model_change(events: DataFrame) -> DataFrame:
    return events.select("event_id", scoring.changed((F.col("value") - 20) / 10, (F.col("user_id") % 50 - 25) * 1.0).alias("change"))


def _wave(step: float, shift: float):  # noqa: ANN202
    """A stand-in for a user's network of one score."""
    weights = np.cos(np.arange(64) * step + shift)
    return lambda: lambda x: (np.asarray(x, np.float64).reshape(-1, 64) @ weights)[:, None].astype(np.float32)


@query("u2_model_changes", "embeddings", sql="""with s as (select vec_id, list_sum(list_transform(embedding, lambda x, i: x::double * cos((i - 1) * 1.0e0))) as a, list_sum(list_transform(embedding, lambda x, i: x::double * cos((i - 1) * 0.5e0 + 1.0e0))) as b from embeddings)
select vec_id, case when a > 0 then 1 else 0 end as one, case when a > 0 or b > 0 then 1 else 0 end as change from s""")
def model_changes(embeddings: DataFrame) -> DataFrame:
    """Two models score each vector; either of them may see change."""
    both = scoring.scored(embeddings.select("vec_id", "embedding"), "embedding", _wave(1.0, 0.0), [64], batch=32, out="a")
    both = scoring.scored(both, "embedding", _wave(0.5, 1.0), [64], batch=16, out="b")
    a, b = F.col("a")[0], F.col("b")[0]
    return both.select("vec_id", scoring.changed(a).alias("one"), scoring.changed(a, b).alias("change"))


@query("h23_low_frequency_transfer", "v_cells")
def low_frequency_transfer(cells: DataFrame) -> DataFrame:
    bands = cells.select("scene_id", "r", "c", (F.col("pre_class") * 18).alias("pre"), (F.col("post_class") * 18).alias("post"))
    return scoring.by_tile(bands, 16, ["pre", "post"], scoring.low_frequencies_of).groupBy("scene_id").agg(F.sum("v").alias("total"), F.count("*").alias("cells"))


@query("h25_adaptive_equalisation", "v_cells")
def adaptive_equalisation(cells: DataFrame) -> DataFrame:
    band = cells.select("scene_id", "r", "c", (F.col("post_class") * 18).alias("b"))
    return scoring.by_tile(band, 64, ["b"], lambda x: scoring.equalised(np.clip(x, 0, 255))).groupBy("scene_id").agg(F.sum("v").alias("total"), F.max("v").alias("top"))


@query("h46_turned_averages", "embeddings", sql="""select vec_id, round(list_sum(list_transform(embedding, lambda x, i: x::double * i * 0.875e0
 * (pow((i - 1) // 8, 2) + pow(7 - (i - 1) // 8, 2) + pow((i - 1) % 8, 2) + pow(7 - (i - 1) % 8, 2)))) / 4096, 5) as moment from embeddings""")
def turned_averages(embeddings: DataFrame) -> DataFrame:
    """A model that weighs a cell by the square of its row times its column: its mean over the eight forms is a sum of squares.

    The moment counts each cell by its place, so that a form turned back wrongly would be seen.
    """
    row = lambda k: F.slice("embedding", 8 * k + 1, 8).cast("array<double>")
    grids = embeddings.select("vec_id", F.array(*[row(k) for k in range(8)]).alias("grid"))
    weights = np.outer(np.arange(8.0) ** 2, np.arange(8.0))
    out = scoring.averaged(grids, "grid", lambda x: x * weights, "mean_grid")
    placed = F.transform(F.flatten("mean_grid"), lambda v, i: v * (i + 1))
    return out.select("vec_id", F.round(F.aggregate(placed, F.lit(0.0), lambda s, v: s + v) / 4096, 5).alias("moment"))


_TURNED = """select image_id, category_id, box_id, is_gt, case when box_id % 2 = 1 then (x0 + x1 - y1 + y0) / 2 else x0 end as x0, case when box_id % 2 = 1 then (y0 + y1 - x1 + x0) / 2 else y0 end as y0,
 case when box_id % 2 = 1 then (x0 + x1 + y1 - y0) / 2 else x1 end as x1, case when box_id % 2 = 1 then (y0 + y1 + x1 - x0) / 2 else y1 end as y1 from v_boxes"""


@query("j14_rotated_iou", "v_boxes", sql=f"""with v as ({_TURNED}), p as (select a.box_id as a, b.box_id as b, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) as s,
 (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) as t from v a join v b on a.image_id = b.image_id and a.category_id = b.category_id and a.is_gt = 0 and b.is_gt = 1)
select a, b, round(s / (t - s), 5) as iou from p where s / (t - s) > 1e-6""")
def rotated_iou(boxes: DataFrame) -> DataFrame:
    """Boxes with an odd id are turned by 90 degrees: upright ones with their sides exchanged. Others are turned by 180."""
    from geoledger.functions.boxes import box, centre

    x, y = centre(box())
    turned = boxes.withColumns({"cx": x, "cy": y, "w": F.col("x1") - F.col("x0"), "h": F.col("y1") - F.col("y0"), "angle": F.when(F.col("box_id") % 2 == 1, 90.0).otherwise(180.0)})
    pairs = scoring.rotated_pairs(turned.where("is_gt = 0"), turned.where("is_gt = 1"), ["image_id", "category_id"])
    return pairs.where("iou > 1e-6").select(F.col("a.box_id").alias("a"), F.col("b.box_id").alias("b"), F.round("iou", 5).alias("iou"))


@query("k9_iou_tracks", "v_boxes")
def iou_tracks(boxes: DataFrame) -> DataFrame:
    videos = boxes.where("is_gt = 0").withColumn("video", F.floor(F.col("image_id") / 20).cast("long"))
    tracks = scoring.tracked(videos, "video", "image_id", "box_id", least=0.3)
    return tracks.groupBy("video").agg(F.count_distinct("track").alias("tracks"), F.count("*").alias("boxes"))


@query("k10_assigned_tracks", "v_boxes")
def assigned_tracks(boxes: DataFrame) -> DataFrame:
    videos = boxes.where("is_gt = 0").withColumn("video", F.floor(F.col("image_id") / 20).cast("long"))
    tracks = scoring.tracked(videos, "video", "image_id", "box_id", least=0.3, method="assignment")
    return tracks.groupBy("video").agg(F.count_distinct("track").alias("tracks"), F.count("*").alias("boxes"))
