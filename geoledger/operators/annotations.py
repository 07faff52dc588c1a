"""Annotation data sets: records of images with nested annotations, categories and their frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger.functions.boxes import box, clipped


def nested(rows: DataFrame, image: str, fields: list[str]) -> DataFrame:
    """One row per image with its annotations as an array of structs, in order of the first field."""
    return rows.groupBy(image).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("annotations"))


def without_crowd_only(images: DataFrame) -> DataFrame:
    """Images that have an annotation which isn't a crowd."""
    return images.where(F.exists("annotations", lambda a: F.coalesce(a["iscrowd"], F.lit(0)) == 0))


def with_visible_keypoints(images: DataFrame, least: int) -> DataFrame:
    """Images with so many keypoints whose visibility, each third value, is above 0."""
    seen = lambda points: F.size(F.filter(points, lambda v, i: (i % 3 == 2) & (v > 0)))
    return images.where(F.aggregate("annotations", F.lit(0), lambda s, a: s + seen(a["keypoints"])) >= least)


def remapped(images: DataFrame, categories: dict[int, int]) -> DataFrame:
    """Annotations of the known categories, under their new ids; others go."""
    known = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    kept = F.filter("annotations", lambda a: F.map_contains_key(known, a["category_id"].cast("int")))
    return images.withColumn("annotations", F.transform(kept, lambda a: a.withField("category_id", F.element_at(known, a["category_id"].cast("int")).cast("long"))))


def contiguous(rows: DataFrame, category: str) -> DataFrame:
    """(category, contiguous): ids in order, from 0. Categories are few: some thousands at most, so that one task ranks them."""
    from pyspark.sql.window import Window

    return rows.select(category).distinct().withColumn("contiguous", (F.dense_rank().over(Window.orderBy(category)) - 1).cast("long"))


def frequencies(anns: DataFrame) -> DataFrame:
    """(category_id, f): the share of images that have each category."""
    pairs = anns.select("image_id", "category_id").distinct()
    total = anns.select("image_id").distinct().count()
    counts = pairs.groupBy("category_id").agg(F.count("*").alias("n"))
    return counts.select("category_id", (F.col("n") / F.lit(float(max(1, total)))).alias("f"))


def repeat_factors(anns: DataFrame, threshold: float) -> DataFrame:
    """(image_id, factor): the largest max(1, sqrt(threshold / frequency)) of an image's categories."""
    factor = frequencies(anns).select("category_id", F.greatest(F.lit(1.0), F.sqrt(F.lit(threshold) / F.col("f"))).alias("r"))
    return anns.join(factor, "category_id").groupBy("image_id").agg(F.max("r").alias("factor"))


def weighted(factors: DataFrame, dataset_factor: Column) -> DataFrame:
    """``factors`` with ``weight``: data set times category factor, by the least of all."""
    both = factors.withColumn("weight", F.col("factor") * dataset_factor)
    least = both.agg(F.min("weight")).first()[0]
    return both.withColumn("weight", F.col("weight") / F.lit(least))


def frequency_weights(anns: DataFrame, power: float) -> DataFrame:
    """(category_id, weight): number of images to a power."""
    return anns.groupBy("category_id").agg(F.pow(F.count_distinct("image_id"), F.lit(power)).alias("weight"))


def name_conflicts(named: DataFrame) -> DataFrame:
    """(category_id, names) of ids that have several names."""
    return named.groupBy("category_id").agg(F.count_distinct("name").alias("names")).where("names > 1")


def overridden(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of both by key, the right side's columns over the left's."""
    return left.drop(*[c for c in right.columns if c != key]).join(right, key)


def flipped(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """Boxes mirrored left to right and clipped to the image."""
    b = box()
    out = clipped((width - b[2], b[1], width - b[0], b[3]), width, height)
    return boxes.withColumns(dict(zip(("x0", "y0", "x1", "y1"), out, strict=True)))
