"""Raster algebra on long tables: one row per cell with scene_id, r, c and values.

Neighbourhoods are made by sending each cell to its neighbours' places (one shuffle), never by gathering a scene.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.operators.graph import connected_components
from geoledger.scratch import written

CROSS = [(0, 0), (0, 1), (1, 0), (0, -1), (-1, 0)]
SQUARE = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def histogram(cells: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """(keys, value, n) without the first and the last bin."""
    return cells.where(~F.col(value).isin(0, bins - 1)).groupBy(*keys, value).agg(F.count("*").alias("n"))


def sampled_histogram(cells: DataFrame, keys: list[str], value: str, place: str, stride: int, no_data: int, edge: int, bins: int = 256) -> DataFrame:
    """Of every ``stride``-th place and without no-data; values are clamped, and the ``edge`` bins at both ends left out."""
    v = F.least(F.greatest(F.col(value), F.lit(edge)), F.lit(bins - 1 - edge))
    some = cells.where((F.col(value) != no_data) & (F.col(place) % stride == 0)).withColumn(value, v)
    return some.where(~F.col(value).isin(edge, bins - 1 - edge)).groupBy(*keys, value).agg(F.count("*").alias("n"))


def cumulative(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts with ``q``, the share of values up to each."""
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("q", F.sum("n").over(upto).cast("double") / F.sum("n").over(Window.partitionBy(*keys)))


def clip_values(counts: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """(keys, low, high): the values whose cumulative shares are nearest to ``share`` and to 1 - ``share``."""
    near = lambda p: F.min_by(value, F.struct(F.abs(F.col("q") - p), F.col(value)))
    return cumulative(counts, keys, value).groupBy(*keys).agg(near(share).alias("low"), near(1 - share).alias("high"))


def percentiles(cells: DataFrame, keys: list[str], value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(keys, low, high): interpolated percentiles of the values that aren't 0."""
    p = F.percentile(value, F.array(F.lit(low), F.lit(high)))
    return cells.where(F.col(value) != 0).groupBy(*keys).agg(p.alias("p")).select(*keys, F.col("p")[0].alias("low"), F.col("p")[1].alias("high"))


def moments(cells: DataFrame, keys: list[str], value: str, scale: float = 255.0) -> DataFrame:
    """(keys, mean, std) of the values that aren't 0; the population's deviation."""
    v = F.col(value) / scale
    return cells.where(F.col(value) != 0).groupBy(*keys).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def normalised(v: Column, mean: float, std: float, scale: float = 255.0) -> Column:
    return (v / scale - mean) / std


def _stretched(cells: DataFrame, bounds: DataFrame, keys: list[str], value: str) -> DataFrame:
    to = F.least(F.greatest((F.col(value) - F.col("low")) * 255.0 / (F.col("high") - F.col("low")), F.lit(0.0)), F.lit(255.0))
    out = cells.join(bounds, keys)
    return out.withColumn(value, F.when(F.col("high") > F.col("low"), F.floor(to).cast("int")).otherwise(F.col(value))).select(*cells.columns)


def percent_stretch(cells: DataFrame, keys: list[str], value: str, share: float, bins: int = 256) -> DataFrame:
    """Values between the clip values of each key spread over 0 to 255."""
    return _stretched(cells, clip_values(histogram(cells, keys, value, bins), keys, value, share), keys, value)


def linear_stretch(cells: DataFrame, keys: list[str], value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Values between interpolated percentiles spread over 0 to 255; keys with zeros only stay as they are."""
    out = cells.join(percentiles(cells, keys, value, low, high), keys, "left")
    to = F.least(F.greatest((F.col(value) - F.col("low")) * 255.0 / (F.col("high") - F.col("low")), F.lit(0.0)), F.lit(255.0))
    return out.withColumn(value, F.when(F.col("high") > F.col("low"), F.floor(to).cast("int")).otherwise(F.col(value))).select(*cells.columns)


# Fixed values of the five-segment stretch: least and greatest weights of its segments, in steps of 1 / 255.
_SEGMENTS = {"dark": (4.0, 0, 10), "left": (2.0, 10, 60), "middle": (0.5, 100, 160), "right": (2.0, 10, 60), "white": (4.0, 0, 10)}


def stretch_bounds(cells: DataFrame, dense: DataFrame, keys: list[str], value: str, left: float, right: float, narrow: bool) -> DataFrame:
    """(keys, low, valid0, clip0, clip1, valid1, high, and a weight for each segment) of the five-segment stretch.

    ``valid`` are the values at all but a millionth of the cells, ``clip`` those at the shares ``left`` and ``right``; ``narrow``
    keeps the valid range within a tenth below and a half above the clipped one.
    """
    ends = cells.groupBy(*keys).agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    near = lambda p: F.min_by(F.col("v").cast("double"), F.struct(F.abs(F.col("q") - p), F.col("v")))
    at = dense.groupBy(*keys).agg(near(1e-6).alias("valid0"), near(max(left, 1e-6)).alias("clip0"), near(1 - max(right, 1e-6)).alias("clip1"), near(1 - 1e-6).alias("valid1"))
    out = ends.join(at, keys).withColumns({"valid0": F.greatest("valid0", "low"), "valid1": F.least("valid1", "high"), "clip1": F.least("clip1", "high")})
    out = out.withColumn("clip0", F.greatest("clip0", "valid0"))
    if narrow:
        span = F.col("clip1") - F.col("clip0")
        out = out.withColumns({"valid0": F.floor(F.greatest("valid0", F.col("clip0") - 0.1 * span)).cast("double"), "valid1": F.floor(F.least("valid1", F.col("clip1") + 0.5 * span)).cast("double")})
    stops, weights = ["low", "valid0", "clip0", "clip1", "valid1", "high"], {}
    for (name, (part, least, most)), a, b in zip(_SEGMENTS.items(), stops[:-1], stops[1:], strict=True):
        share = (F.col(b) - F.col(a)) / (F.col("high") + 0.1) / part
        weights[name] = F.least(F.greatest(share, F.lit(least / 255)), F.lit(most / 255))
    out = out.withColumns(weights)
    total = sum((F.col(n) for n in list(_SEGMENTS)[1:]), F.col("dark"))
    out = out.withColumns({n: F.col(n) / total for n in ("dark", "left", "middle")}).drop("right", "white")
    # The segments' ends as places in the table, each above the one before.
    out = out.withColumn("low", F.greatest(F.lit(1.0), "low"))
    out = out.withColumn("valid0", F.greatest(F.col("valid0"), F.col("low") + 1)).withColumn("valid1", F.least(F.col("valid1"), F.col("high") - 1))
    return out.withColumn("clip0", F.greatest(F.col("clip0"), F.col("valid0") + 1)).withColumn("clip1", F.least(F.col("clip1"), F.col("valid1") - 1))


def stretch_table(cells: DataFrame, keys: list[str], value: str, left: float = 0.001, right: float = 0.001, bins: int = 256, narrow: bool = False, limit: float = 0.02, gamma: float | None = None) -> DataFrame:
    """(keys, v, to): the 8-bit table of the five-segment stretch, a row for each value of each key.

    Dark, left and middle values are spread by their segments' weights. From the right clip value on the histogram is
    equalised: bins above ``limit`` of its sum are cut, and what is cut off is shared out over the bins below the limit,
    first evenly in whole cells, then what is left in equal steps over those that are still below.
    """
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Sums of fractions depend on the order of their terms, and are rounded to whole cells: it is that of the values.
    ordered = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    every = cells.select(*keys).distinct().withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    counts = histogram(cells, keys, value, bins).withColumnRenamed(value, "v")
    dense = every.join(counts, [*keys, "v"], "left").na.fill(0, ["n"]).withColumn("q", F.sum("n").over(upto) / (F.sum("n").over(whole) + 1e-5))
    t = dense.join(stretch_bounds(cells, dense, keys, value, left, right, narrow), keys)
    v = F.least(F.col("v").cast("double"), F.col("high"))
    t = t.withColumn("to", F.when(F.col("v") < F.col("low"), 1.0).otherwise(v))
    before = lambda stop: F.max(F.when(F.col("v") == F.col(stop) - 1, F.col("to"))).over(whole)
    for a, b, weight in (("low", "valid0", "dark"), ("valid0", "clip0", "left"), ("clip0", "clip1", "middle")):
        here = (F.col("v") >= F.col(a)) & (F.col("v") < F.col(b))
        spread = F.ceil((v - F.col(a)) / (F.col(b) - F.col(a) + 1) * F.col(weight) * 255.0 + F.col("base"))
        t = t.withColumn("base", F.coalesce(before(a), F.lit(1.0))).withColumn("to", F.when(here, spread.cast("double")).otherwise(F.col("to")))

    top = (F.col("v") >= F.col("clip1")) & (F.col("v") < F.col("high"))
    over = lambda c: F.sum(F.when(F.col("top"), c)).over(ordered)
    t = t.withColumns({"base": F.coalesce(before("clip1"), F.lit(1.0)), "top": top, "h": F.col("n").cast("double")})
    t = t.withColumn("most", over(F.col("h")) * limit)
    t = t.withColumns({"excess": over(F.greatest(F.col("h") - F.col("most"), F.lit(0.0))), "h": F.least("h", "most")})
    t = t.withColumn("more", F.floor(F.col("excess") / (F.col("high") - F.col("clip1"))))
    low = F.col("h") < F.col("most") - F.col("more")
    t = t.withColumns({"excess": F.col("excess") - F.col("more") * over(low.cast("int")), "h": F.when(low, F.col("h") + F.col("more")).otherwise(F.col("h"))})
    middle = (F.col("h") >= F.col("most") - F.col("more")) & (F.col("h") < F.col("most"))
    t = t.withColumns({"excess": F.col("excess") - over(F.when(middle, F.col("most") - F.col("h")).otherwise(0.0)), "h": F.when(middle, F.col("most")).otherwise(F.col("h"))})
    under = F.col("top") & (F.col("h") < F.col("most"))
    t = t.withColumns({"m": F.sum(under.cast("int")).over(whole), "j": F.sum(under.cast("int")).over(upto), "left_over": F.greatest(F.ceil("excess"), F.lit(0))})
    step = F.floor(F.col("j") * F.col("left_over") / F.col("m")) - F.floor((F.col("j") - 1) * F.col("left_over") / F.col("m"))
    t = t.withColumn("h", F.when(under, F.col("h") + step).when(F.col("top"), F.col("h")).otherwise(0.0))
    share = F.sum("h").over(upto) / (F.sum("h").over(ordered) + 0.01)
    t = t.withColumn("to", F.when(F.col("top"), F.floor((256 - F.col("base")) * share + F.col("base")).cast("double")).otherwise(F.col("to")))
    t = t.withColumn("to", F.floor(F.least(F.greatest("to", F.lit(1.0)), F.lit(255.0))).cast("double"))
    if gamma is not None:
        largest = F.max("to").over(whole)
        t = t.withColumn("to", F.round(F.pow(F.col("to") / largest, F.lit(gamma)) * largest))
    return t.select(*keys, "v", F.col("to").cast("int").alias("to"))


def no_data_edges(cells: DataFrame, scene: str, value: str, height: int, width: int, no_data: int = 0, dark: int = 10, edge: int = 30, shape: str = "cross") -> DataFrame:
    """(scene, r, c, masked): cells without data, and dark ones within ``edge`` cells of the border, opened and then closed."""
    at_edge = (F.col("r") < edge) | (F.col("r") >= height - edge) | (F.col("c") < edge) | (F.col("c") >= width - edge)
    mask = (F.col(value) <= no_data) | at_edge & (F.col(value) < dark)
    bits = cells.select(scene, "r", "c", mask.cast("int").alias("masked"))
    return closed(opened(bits, scene, "masked", shape), scene, "masked", shape)


def segment_stretch(cells: DataFrame, scene: str, value: str, height: int, width: int, edge: int = 30, **options: float | bool | None) -> DataFrame:
    """``cells`` with values by the table of their scene (see :func:`stretch_table`), and 0 at the edges without data."""
    table = stretch_table(cells, [scene], value, **options).withColumnRenamed("v", value)
    masked = no_data_edges(cells, scene, value, height, width, edge=edge)
    out = cells.join(table, [scene, value]).join(masked, [scene, "r", "c"])
    return out.withColumn(value, F.when(F.col("masked") == 1, 0).otherwise(F.col("to"))).select(*cells.columns)


def _offsets(offsets: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets]))


def morphology(cells: DataFrame, scene: str, value: str, how: str, shape: str, rounds: int = 1) -> DataFrame:
    """Largest (dilation) or least (erosion) value around each cell; cells that aren't there say nothing.

    One shuffle a round: cells are sent to their neighbours' places, and only places with a cell of their own stay.
    """
    offsets = CROSS if shape == "cross" else SQUARE
    for _ in range(rounds):
        sent = cells.select(scene, "r", "c", value, _offsets(offsets).alias("d"))
        own = (F.col("d.dy") == 0) & (F.col("d.dx") == 0)
        at = sent.groupBy(scene, (F.col("r") + F.col("d.dy")).alias("r"), (F.col("c") + F.col("d.dx")).alias("c"))
        cells = at.agg(getattr(F, how)(value).alias(value), F.bool_or(own).alias("here")).where("here").select(scene, "r", "c", value)
    return cells


def opened(cells: DataFrame, scene: str, value: str, shape: str = "cross") -> DataFrame:
    return morphology(morphology(cells, scene, value, "min", shape), scene, value, "max", shape)


def closed(cells: DataFrame, scene: str, value: str, shape: str = "cross") -> DataFrame:
    return morphology(morphology(cells, scene, value, "max", shape), scene, value, "min", shape)


def grid(cells: DataFrame, scene: str, height: int, width: int) -> DataFrame:
    """Every place of each scene."""
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    return cells.select(scene).distinct().withColumn("r", upto(height)).withColumn("c", upto(width))


def padded(cells: DataFrame, scene: str, value: str, height: int, width: int) -> DataFrame:
    """Cells that aren't there are 0."""
    return grid(cells, scene, height, width).join(cells, [scene, "r", "c"], "left").select(scene, "r", "c", F.coalesce(value, F.lit(0)).alias(value))


def mirrored(cells: DataFrame, scene: str, value: str, height: int, width: int, to_height: int, to_width: int) -> DataFrame:
    """The edge's neighbours mirrored beyond it, the edge itself not repeated."""
    # A cell is sent to its own place and to those that it is the mirror image of: no grid is made, and nothing joined.
    def places(c: str, n: int, to: int) -> Column:
        own, beyond = F.col(c).cast("long"), 2 * (n - 1) - F.col(c).cast("long")
        return F.explode(F.array_compact(F.array(F.when((own >= 0) & (own < min(n, to)), own), F.when((beyond >= n) & (beyond < to), beyond))))

    sent = cells.withColumn("_r", places("r", height, to_height)).withColumn("_c", places("c", width, to_width))
    return sent.select(scene, F.col("_r").alias("r"), F.col("_c").alias("c"), value)


def tile_index(scenes: DataFrame, keys: list[str], size: int, overlap: int) -> DataFrame:
    """(keys, x, y, pad_right, pad_down) of the tiles that cover scenes of given width and height; -1 where the edge is met exactly."""
    step = size - overlap
    starts = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n) - overlap - 1, F.lit(0)).cast("long"), F.lit(step).cast("long")))
    pad = lambda at, n: F.when(F.col(at) + size == F.col(n), -1).otherwise(F.greatest(F.col(at) + size - F.col(n), F.lit(0))).cast("long")
    tiles = scenes.withColumn("x", starts("width")).withColumn("y", starts("height"))
    return tiles.select(*keys, "x", "y", pad("x", "width").alias("pad_right"), pad("y", "height").alias("pad_down"))


def nearest(cells: DataFrame, scene: str, value: str, height: int, width: int, factor: float) -> DataFrame:
    """A new grid whose cells are ``factor`` old ones wide: each has the value at its centre, 0 without any."""
    from_ = lambda c: F.floor((F.col(c) + 0.5) * factor)
    wanted = grid(cells, scene, height, width).withColumns({"fr": from_("r"), "fc": from_("c")})
    source = cells.select(scene, F.col("r").cast("long").alias("fr"), F.col("c").cast("long").alias("fc"), value)
    return wanted.join(source, [scene, "fr", "fc"], "left").select(scene, "r", "c", F.coalesce(value, F.lit(0)).alias(value))


def bilinear(cells: DataFrame, scene: str, value: str, height: int, width: int, to_height: int, to_width: int) -> DataFrame:
    """A new grid with the corners aligned: each cell is the weighted sum of its four neighbours."""
    wanted = grid(cells, scene, to_height, to_width)
    wanted = wanted.withColumns({"y": F.col("r") * ((height - 1) / max(1, to_height - 1)), "x": F.col("c") * ((width - 1) / max(1, to_width - 1))})
    near = wanted.select(scene, "r", "c", "y", "x", _offsets([(0, 0), (0, 1), (1, 0), (1, 1)]).alias("d"))
    near = near.withColumns({"fr": F.floor("y") + F.col("d.dy"), "fc": F.floor("x") + F.col("d.dx")})
    near = near.withColumn("w", (1 - F.abs(F.col("y") - F.col("fr"))) * (1 - F.abs(F.col("x") - F.col("fc")))).where("w > 0")
    source = cells.select(scene, F.col("r").cast("long").alias("fr"), F.col("c").cast("long").alias("fc"), value)
    return near.join(source, [scene, "fr", "fc"], "left").groupBy(scene, "r", "c").agg(F.sum(F.col("w") * F.coalesce(value, F.lit(0))).alias(value))


def patches(cells: DataFrame, scene: str, value: str, window: int, height: int, width: int) -> DataFrame:
    """(scene, r, c, patch): the window around each cell in order, the edge's cells repeated beyond it."""
    half = window // 2
    offsets = [(dy, dx) for dy in range(-half, window - half) for dx in range(-half, window - half)]
    inside = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1))
    wanted = cells.select(scene, "r", "c", _offsets(offsets).alias("d"))
    wanted = wanted.withColumns({"fr": inside(F.col("r") + F.col("d.dy"), height), "fc": inside(F.col("c") + F.col("d.dx"), width)})
    source = cells.select(scene, F.col("r").alias("fr"), F.col("c").alias("fc"), value)
    filled = wanted.join(source, [scene, "fr", "fc"], "left")
    return filled.groupBy(scene, "r", "c").agg(F.sort_array(F.collect_list(F.struct("d.dy", "d.dx", F.col(value).alias("v")))).alias("patch"))


def overviews(cells: DataFrame, value: str, factors: list[int]) -> DataFrame:
    """(factor, scene_id, r, c, value): every factor-th row and column."""
    each = cells.withColumn("factor", F.explode(F.array(*[F.lit(f) for f in factors])))
    down = lambda c: F.floor(F.col(c) / F.col("factor")).cast("long")
    return each.where("r % factor = 0 and c % factor = 0").select("factor", "scene_id", down("r").alias("r"), down("c").alias("c"), value)


def tiled(cells: DataFrame, size: int, overlap: int, width: int, height: int) -> DataFrame:
    """Cells with the tiles they are in (x, y) and their place there (tr, tc); in the overlap a cell is in several."""
    step = size - overlap

    def tiles(c: str, n: int) -> Column:
        last = max(0, -(-(n - overlap) // step) - 1)
        first = F.greatest(F.ceil((F.col(c) - size + 1) / F.lit(float(step))), F.lit(0))
        return F.explode(F.sequence(first.cast("int"), F.least(F.floor(F.col(c) / F.lit(float(step))), F.lit(last)).cast("int")))

    out = cells.withColumn("i", tiles("c", width)).withColumn("j", tiles("r", height))
    out = out.withColumns({"x": F.col("i") * step, "y": F.col("j") * step})
    return out.withColumns({"tr": F.col("r") - F.col("y"), "tc": F.col("c") - F.col("x")}).drop("r", "c", "i", "j")


def mosaic(tiles: DataFrame, size: int, overlap: int, width: int, height: int) -> DataFrame:
    """Tiles put back: each gives its middle, without half of the overlap, except at the scene's edges."""
    half, step = overlap // 2, size - overlap

    def own(at: str, start: str, n: int) -> Column:
        last = max(0, -(-(n - overlap) // step) - 1) * step
        low = F.when(F.col(start) == 0, 0).otherwise(half)
        high = F.when(F.col(start) == last, n).otherwise(size - (overlap - half))
        return (F.col(at) >= low) & (F.col(at) < high)

    out = tiles.where(own("tr", "y", height) & own("tc", "x", width)).withColumns({"r": F.col("y") + F.col("tr"), "c": F.col("x") + F.col("tc")})
    return out.drop("x", "y", "tr", "tc")


def stacked(pre: DataFrame, post: DataFrame) -> DataFrame:
    """Cells of both dates side by side, as columns a.* and b.*; cells of one date only are left out."""
    return pre.alias("a").join(post.alias("b"), ["scene_id", "r", "c"])


def fused(one: DataFrame, two: DataFrame) -> DataFrame:
    """Cells where either model sees change."""
    both = one.unionByName(two)
    return both.groupBy("scene_id", "r", "c").agg(F.max("change").alias("change"))


def without_empty_tiles(cells: DataFrame, size: int, valid: Column) -> DataFrame:
    """Cells of tiles that have a valid cell."""
    at = lambda c: F.floor(F.col(c) / F.lit(float(size)))
    dealt = cells.withColumns({"tr": at("r"), "tc": at("c")})
    some = dealt.where(valid).select("scene_id", "tr", "tc").distinct()
    return dealt.join(some, ["scene_id", "tr", "tc"], "left_semi").drop("tr", "tc")


def runs(cells: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, r, c0, c1, value): stretches of equal values along rows."""
    row = Window.partitionBy(*keys, "r").orderBy("c")
    same = Window.partitionBy(*keys, "r", value).orderBy("c")
    island = F.col("c") - F.row_number().over(same)
    return cells.withColumn("island", island).withColumn("place", F.row_number().over(row)).groupBy(*keys, "r", value, "island").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).drop("island")


def cells_of(runs_: DataFrame) -> DataFrame:
    """Runs back to cells."""
    return runs_.withColumn("c", F.explode(F.sequence("c0", "c1"))).drop("c0", "c1")


def components(cells: DataFrame, width: int, diagonal: bool = False) -> DataFrame:
    """Cells (scene_id, r, c, v) with ``label``, the first cell (r * width + c) of their connected region of equal value.

    Rows' runs are the vertices, so that a region has as many edges as it has runs that touch, and the labels are found
    by star contraction in a number of rounds that grows with the logarithm of the region.
    """
    id_ = F.col("scene_id") * F.lit(1 << 40) + F.col("r") * F.lit(width) + F.col("c0")
    all_runs = written(runs(cells, ["scene_id"], "v").withColumn("id", id_.cast("long")), "runs")
    below = all_runs.select("scene_id", "v", (F.col("r") - 1).alias("r"), F.col("c0").alias("b0"), F.col("c1").alias("b1"), F.col("id").alias("other"))
    reach = 1 if diagonal else 0
    touching = all_runs.join(below, ["scene_id", "v", "r"]).where((F.col("b0") <= F.col("c1") + reach) & (F.col("b1") >= F.col("c0") - reach))
    labels = connected_components(touching.select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "id")
    labelled = all_runs.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id") % F.lit(1 << 40)).drop("component", "id")
    return cells_of(labelled)


def longest_outlines(labelled: DataFrame, n: int) -> DataFrame:
    """(scene_id, label, outline): the n regions of each scene with most sides that face another region or none."""
    near = labelled.select("scene_id", "r", "c", "label", _offsets([o for o in CROSS if o != (0, 0)]).alias("d"))
    other = labelled.select("scene_id", F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("label").alias("label2"))
    near = near.withColumns({"r2": F.col("r") + F.col("d.dy"), "c2": F.col("c") + F.col("d.dx")})
    faced = near.join(other, ["scene_id", "r2", "c2"], "left").where(~F.col("label").eqNullSafe(F.col("label2")))
    order = Window.partitionBy("scene_id").orderBy(F.desc("outline"), "label")
    outlines = faced.groupBy("scene_id", "label").agg(F.count("*").alias("outline"))
    return outlines.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).drop("_k")
