"""Overlays of boxes and polygons: joins on cells of a hierarchy of grids, with the exact test as residual.

A box lies at the level whose cells are about as large as it is, and touches a few of them. Two boxes meet at the level of
the larger one: it is there with its own cells, and the smaller one with those it touches at that level. So a box has a few
rows for each level of the other side, however large or small it is, and no size of tiles needs to be chosen.

A broadcast of the smaller side is left to the planner, which checks its size; the cells keep the join an equi-join
whichever way it goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.functions.boxes import Box, area, ioa, iou, overlap
from geoledger.scratch import written

#: Levels go from cells of 2^-LEVELS to such of 2^LEVELS; smaller and larger boxes lie at the ends.
LEVELS = 60
#: Boxes of a key, of both sides, up to which they meet by the key alone; a box has a few rows for each level otherwise.
CROWD = 1000


def _level(df: DataFrame) -> DataFrame:
    """With ``level``: cells of 2^level are as large as the box's longer side, or up to twice that."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(2.0**-LEVELS))
    return df.withColumn("level", F.least(F.ceil(F.log2(side)), F.lit(LEVELS)).cast("int"))


def _cells(df: DataFrame) -> DataFrame:
    """A row for each cell of its ``level`` that a box touches."""
    at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level")))
    over = lambda c: F.explode(F.sequence(at(f"{c}0"), at(f"{c}1")))
    return df.withColumn("cell_y", over("y")).withColumn("cell_x", over("x"))


def _at_levels(df: DataFrame, other: DataFrame, above: bool) -> DataFrame:
    """``df`` at each level that ``other`` has from (or above) its own; there are 2 * LEVELS + 1 levels at most."""
    levels = other.agg(F.collect_set("level").alias("levels")).scalar()
    met = df.withColumn("other", F.explode(levels))
    return met.where(F.col("other") > F.col("level") if above else F.col("other") >= F.col("level")).withColumn("level", F.col("other")).drop("other")


_SIDES = ("x0", "y0", "x1", "y1")


def _fine(prefix: str = "") -> Column:
    """Whether no side of the box is null or non-finite."""
    return F.expr(" and ".join(f"{prefix}{c} > double('-inf') and {prefix}{c} < double('inf')" for c in _SIDES))


def _shared() -> Column:
    return overlap(tuple(F.col(f"a.{c}") for c in _SIDES), tuple(F.col(f"b.{c}") for c in _SIDES))


def _sides(left: DataFrame, right: DataFrame) -> list[Column]:
    return [F.struct(*[F.col(f"{p}.{c}") for c in df.columns]).alias(p) for p, df in (("a", left), ("b", right))]


def _same(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return on


def _crowded(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame | None:
    """The keys that more than ``CROWD`` boxes share; None if there are none."""
    n = left.select(*keys).unionAll(right.select(*keys)).dropna().groupBy(*keys).agg(F.count("*").alias("_n"))
    some = written(n.where(F.col("_n") > CROWD).select(*keys), "crowded")
    return None if some.isEmpty() else some


def _met_on_grids(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    one, two = _level(left.where(_fine())), _level(right.where(_fine()))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = _cells(a).alias("a"), _cells(b).alias("b")
        first = lambda c: F.floor(F.greatest(F.col(f"a.{c}0"), F.col(f"b.{c}0")) / F.pow(F.lit(2.0), F.col("a.level"))) == F.col(f"a.cell_{c}")
        pairs = a.join(b, _same([*keys, "level", "cell_y", "cell_x"])).where(first("x") & first("y") & (_shared() > 0))
        return pairs.select(*_sides(left, right), _shared().alias("shared"))

    return met(_at_levels(one, two, above=False), two).unionByName(met(one, _at_levels(two, one, above=True)))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pairs of rows whose boxes (x0, y0, x1, y1) share area, once each, as columns of aliases a and b, with ``shared``.

    With ``keys`` only rows that agree in them meet; those of a key with up to ``CROWD`` boxes meet by the key alone. A pair that
    meets in several cells is taken in the first. Boxes with a null or non-finite side meet nothing.
    """
    if not keys:
        return _met_on_grids(left, right, [])
    crowded = _crowded(left, right, keys)
    rest = [df if crowded is None else df.join(crowded, keys, "left_anti") for df in (left, right)]
    a, b = (df.where(_fine()).alias(n) for df, n in zip(rest, "ab", strict=True))
    pairs = a.join(b, _same(keys) & (_shared() > 0)).select(*_sides(left, right), _shared().alias("shared"))
    if crowded is None:
        return pairs
    return pairs.unionByName(_met_on_grids(*(df.join(crowded, keys, "left_semi").select(*df.columns) for df in (left, right)), keys))


def overlapping_or_alone(left: DataFrame, right: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """The same, and each row of ``left`` that meets none once, with b's columns and ``shared`` null.

    Without crowded keys the rows are dealt by ``keys``, so that what follows by them needs no shuffle.
    """
    crowded = _crowded(left, right, keys)
    rest = [df if crowded is None else df.join(crowded, keys, "left_anti") for df in (left, right)]
    a, b = rest[0].alias("a"), rest[1].where(_fine()).alias("b")
    pairs = a.join(b, _same(keys) & _fine("a.") & (_shared() > 0), "left")
    pairs = pairs.select(*_sides(left, right), F.when(F.col("b.x0").isNotNull(), _shared()).alias("shared"))
    if crowded is None:
        return pairs
    many = [df.join(crowded, keys, "left_semi").select(*df.columns) for df in (left, right)]
    met = _met_on_grids(*many, keys)
    alone = many[0].join(met.select(F.col(f"a.{id_}").alias(id_)).distinct(), id_, "left_anti").alias("a")
    none = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]).alias("b")
    alone = alone.select(_sides(left, right)[0], none, F.lit(None).cast("double").alias("shared"))
    return pairs.unionByName(met).unionByName(alone)


def max_overlap(targets: DataFrame, sources: DataFrame, target_id: str, source_id: str, field: str) -> DataFrame:
    """``targets`` with ``field`` of the source that shares most area; equal ones: the least source id; null without any."""
    pairs = overlapping(targets, sources).select(F.col(f"a.{target_id}").alias(target_id), F.col(f"b.{source_id}").alias("s"), F.col(f"b.{field}").alias(field), "shared")
    best = pairs.groupBy(target_id).agg(F.max_by(field, F.struct("shared", -F.col("s"))).alias(field))
    return targets.join(best, target_id, "left")


def attributed(targets: DataFrame, regions: DataFrame, target_id: str, name: str, order: str, unknown: str = "unknown") -> DataFrame:
    """``targets`` with ``province``: the first region in order that contains it, else that with most shared area, else unknown."""
    inside = (F.col("a.x0") >= F.col("b.x0")) & (F.col("a.y0") >= F.col("b.y0")) & (F.col("a.x1") <= F.col("b.x1")) & (F.col("a.y1") <= F.col("b.y1"))
    pairs = overlapping(targets, regions).select(F.col(f"a.{target_id}").alias(target_id), F.col(f"b.{name}").alias("province"), F.col(f"b.{order}").alias("o"), inside.alias("inside"), "shared")
    # Containment in source order beats area; equal areas keep the first.
    rank = F.struct(~F.col("inside"), F.when(F.col("inside"), F.col("o")), -F.col("shared"), F.col("o"))
    best = pairs.groupBy(target_id).agg(F.min_by("province", rank).alias("province"))
    return targets.join(best, target_id, "left").withColumn("province", F.coalesce("province", F.lit(unknown)))


def backfilled(targets: DataFrame, sources: DataFrame, target_id: str, source_id: str, county: str, code: Column) -> DataFrame:
    """``targets`` whose null or 0 ``code`` is filled from the first county, in order, whose most overlapping source has a code."""
    pairs = overlapping(targets, sources).select(F.col(f"a.{target_id}").alias(target_id), F.col(f"b.{county}").alias("county"), F.col(f"b.{source_id}").alias("s"), F.col("b.land_use").alias("land_use"), "shared")
    best = pairs.groupBy(target_id, "county").agg(F.max_by("land_use", F.struct("shared", -F.col("s"))).alias("land_use"))
    filled = best.where("land_use is not null and land_use <> 0").groupBy(target_id).agg(F.min_by("land_use", "county").alias("land_use"))
    own = F.when(F.col("code") != 0, F.col("code"))
    return targets.join(filled, target_id, "left").withColumn("code", F.coalesce(own, code, F.lit(0))).drop("land_use")


def pairwise(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of two box sets that agree in the keys and share area, with iou, ioa and shared area."""
    box = lambda p: tuple(F.col(f"{p}.{c}") for c in ("x0", "y0", "x1", "y1"))
    pairs = overlapping(left, right, keys)
    return pairs.withColumns({"iou": iou(box("a"), box("b")), "ioa": ioa(box("a"), box("b"))})


def pairwise_or_alone(left: DataFrame, right: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """The same, and each row of ``left`` that meets none once, with b's columns, iou and ioa null."""
    box = lambda p: tuple(F.col(f"{p}.{c}") for c in _SIDES)
    pairs = overlapping_or_alone(left, right, keys, id_)
    return pairs.withColumns({n: F.when(F.col("shared").isNotNull(), f(box("a"), box("b"))) for n, f in (("iou", iou), ("ioa", ioa))})


def with_strangers(pairs: DataFrame, predictions: DataFrame, truths: DataFrame, keys: list[str], prediction: str, truth: str) -> DataFrame:
    """(keys, prediction, truth, iou) with a row for each prediction without a pair: the least truth of its keys, iou 0.

    That is what a table of all pairs would give such a prediction as its best truth; those of keys without truths have no row.
    """
    some = pairs.select(*keys, prediction, truth, "iou")
    least = truths.groupBy(*keys).agg(F.min(truth).alias(truth))
    alone = predictions.join(some.select(prediction).distinct(), prediction, "left_anti").join(least, keys)
    return some.unionByName(alone.select(*keys, prediction, truth, F.lit(0.0).alias("iou")))


def matched(quality: DataFrame, prediction: str, truth: str, low: float, high: float, promote: bool = False, keys: list[str] | None = None) -> DataFrame:
    """(prediction, truth, iou, label) from (prediction, truth, iou): the best truth of each, label 0 below low, -1 between, 1 from high.

    ``promote`` gives label 1 to the best predictions, ties too, of each truth. Rows that are dealt by ``keys``, which a prediction and
    a truth have one value of each, stay where they are.
    """
    keys, chosen = keys or [], F.bool_or(F.lit(False))
    if promote:
        top = Window.partitionBy(*keys, truth)
        quality = quality.withColumn("_top", F.max("iou").over(top))
        chosen = F.bool_or((F.col("iou") > 0) & (F.col("iou") == F.col("_top")))
    best = quality.groupBy(*keys, prediction).agg(F.max_by(F.struct(truth, "iou"), F.struct("iou", -F.col(truth))).alias("m"), chosen.alias("chosen"))
    label = F.when(F.col("chosen"), 1).when(F.col("m.iou") < low, 0).when(F.col("m.iou") < high, -1).otherwise(1)
    return best.select(prediction, F.col(f"m.{truth}").alias(truth), F.col("m.iou").alias("iou"), label.alias("label"))


def point_distances(points: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Left, top, right and bottom distance of every point to every box of its image."""
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    pairs = points.alias("a").join(boxes.alias("b"), on)
    return pairs.withColumns({"left": F.col("a.x") - F.col("b.x0"), "top": F.col("a.y") - F.col("b.y0"), "right": F.col("b.x1") - F.col("a.x"), "bottom": F.col("b.y1") - F.col("a.y")})


def with_area(df: DataFrame, box: Box) -> DataFrame:
    return df.withColumn("area", area(box))
