"""Class counts per polygon, and classes by majority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger.functions.classes import class_name, major_class

#: Rows and columns of cells that go to one bucket of the join between polygons and cells.
TILE = 16


def zonal_counts(polygons: DataFrame, cells: DataFrame, classes: list[str], tile: int = TILE) -> DataFrame:
    """(scene_id, fid, then for each of ``classes`` a row by layer: layer, class, n): cells by centre within rectangles, class 0 left out.

    Polygons are dealt to the tiles they touch, so that the join is on (scene, tile) with the exact test as residual, and
    a large polygon is spread over as many tasks as it has tiles.
    """
    at = lambda c: F.floor(c / F.lit(float(tile)))
    touched = lambda c: F.explode(F.sequence(at(F.col(f"{c}0")), at(F.col(f"{c}1") - 1)))
    zones = polygons.where("y1 > y0 and x1 > x0").withColumn("tile_r", touched("y")).withColumn("tile_c", touched("x"))
    tiled = cells.withColumns({"tile_r": at(F.col("r")), "tile_c": at(F.col("c"))})
    inside = (F.col("c") >= F.col("x0")) & (F.col("c") < F.col("x1")) & (F.col("r") >= F.col("y0")) & (F.col("r") < F.col("y1"))
    joined = zones.join(tiled, ["scene_id", "tile_r", "tile_c"]).where(inside)
    # Counted by both classes at once, then taken apart: one shuffle for all layers.
    counted = joined.groupBy("scene_id", "fid", *classes).agg(F.count("*").alias("n"))
    layers = F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("cls")) for c in classes]))
    each = counted.select("scene_id", "fid", layers.alias("x"), "n").where("x.cls != 0")
    return each.groupBy("scene_id", "fid", F.col("x.layer").alias("layer"), F.col("x.cls").alias("cls")).agg(F.sum("n").alias("n"))


def majority(counts: DataFrame, keys: list[str], code: Column, default: int = 0) -> DataFrame:
    """(keys, code): the code with most cells; codes 0 and counts that aren't positive say nothing; ties take the smaller code."""
    mapped = counts.select(*keys, code.alias("code"), F.col("n").cast("long").alias("n"))
    summed = mapped.groupBy(*keys, "code").agg(F.sum(F.when((F.col("n") > 0) & (F.col("code") != 0), F.col("n"))).alias("n"))
    best = F.max_by(F.col("code"), F.when(F.col("n") > 0, F.struct(F.col("n"), -F.col("code"))))
    return summed.groupBy(*keys).agg(F.coalesce(best, F.lit(default)).cast("int").alias("code"))


def majority_of_map(counts: Column) -> Column:
    """The same of a map of counts by fine class: major class with most pixels, 0 without any."""
    entries = F.transform(F.map_entries(F.coalesce(counts, F.create_map().cast("map<int,int>"))), lambda e: F.struct(major_class(e["key"]).alias("c"), e["value"].cast("long").alias("n")))

    def total(k: int) -> Column:
        of_k = F.filter(entries, lambda e: (e["c"] == k) & (e["n"] > 0))
        return F.struct(F.aggregate(of_k, F.lit(0).cast("long"), lambda s, e: s + e["n"]).alias("n"), F.lit(-k).alias("k"))

    totals = F.array(*[total(k) for k in range(1, 7)])
    best = F.array_max(totals)
    return F.when(best["n"] > 0, -best["k"]).otherwise(0).cast("int")


def transitions(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    """(pre_code, pre_name, curr_code, curr_name, polygons): how many polygons went from which major class to which."""
    counts = zonal_counts(polygons, cells, ["pre_class", "post_class"])
    major = majority(counts, ["scene_id", "fid", "layer"], major_class(F.col("cls")))
    wide = major.groupBy("scene_id", "fid").agg(*[F.max(F.when(F.col("layer") == c, F.col("code"))).alias(n) for c, n in (("pre_class", "pre"), ("post_class", "post"))])
    all_ = polygons.select("scene_id", "fid").join(wide, ["scene_id", "fid"], "left")
    coded = all_.select(F.coalesce("pre", F.lit(0)).alias("pre_code"), F.coalesce("post", F.lit(0)).alias("curr_code"))
    out = coded.groupBy("pre_code", "curr_code").agg(F.count("*").alias("polygons"))
    return out.select("pre_code", class_name(F.col("pre_code")).alias("pre_name"), "curr_code", class_name(F.col("curr_code")).alias("curr_name"), "polygons")


def format_result(features: DataFrame) -> DataFrame:
    """The final layer's seven columns in order: missing ones are added, null codes become 0, names follow the codes."""
    have = set(features.columns)
    get = lambda name, kind, default: F.coalesce(F.col(name).cast(kind), F.lit(default).cast(kind)) if name in have else F.lit(default).cast(kind)
    pre, curr = get("pre_code", "int", 0), get("curr_code", "int", 0)
    geometry = F.col("geometry") if "geometry" in have else F.lit(None).cast("string")
    return features.select(get("uid", "long", None).alias("uid"), pre.alias("pre_code"), class_name(pre).alias("pre_name"), curr.alias("curr_code"), class_name(curr).alias("curr_name"), get("province", "string", "unknown").alias("province"), geometry.alias("geometry"))
