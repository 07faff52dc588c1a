"""Scores of detections, segmentations and panoptic segments as joins, windows and grouping sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from geoledger.operators.scoring import rotated_iou
from geoledger.scratch import written

#: Slices of a unit of score that running counts are taken in.
SLICES = 1024
#: Rows of a result that a task sends on at a time.
ROWS = 10_000


def confusion(cells: DataFrame, pred: str, truth: str, classes: int, ignore: int | None = None) -> DataFrame:
    """(pred, truth, n); the ignored label is counted as class ``classes``."""
    t = F.when(F.col(truth) == ignore, classes).otherwise(F.col(truth)) if ignore is not None else F.col(truth)
    return cells.groupBy(F.col(pred).alias("pred"), t.alias("truth")).agg(F.count("*").alias("n"))


def segmentation_scores(matrix: DataFrame, classes: int) -> DataFrame:
    """One row per class with truth, and one of class null for all: acc, iou (means for all), fwiou and pixel accuracy.

    Rows and columns of the ignored class (``classes``) are left out.
    """
    valid = matrix.where((F.col("pred") < classes) & (F.col("truth") < classes))
    sums = F.expr("grouping_id(pred, truth)")
    parts = valid.groupingSets([["pred"], ["truth"]], "pred", "truth").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("pred") == F.col("truth"), F.col("n"))).alias("same"), sums.alias("g"))
    own = valid.where("pred = truth").select(F.col("pred").alias("cls"), F.col("n").alias("tp"))
    by_truth = parts.where("g = 2").select(F.col("truth").alias("cls"), F.col("n").alias("in_truth"))
    by_pred = parts.where("g = 1").select(F.col("pred").alias("cls"), F.col("n").alias("in_pred"))
    each = by_truth.join(by_pred, "cls", "left").join(own, "cls", "left").na.fill(0, ["in_pred", "tp"])
    each = each.withColumns({"acc": F.col("tp") / F.col("in_truth"), "iou": F.col("tp") / (F.col("in_truth") + F.col("in_pred") - F.col("tp"))})
    total = each.agg(F.avg("acc").alias("acc"), F.avg("iou").alias("iou"), (F.sum(F.col("iou") * F.col("in_truth")) / F.sum("in_truth")).alias("fwiou"), (F.sum("tp") / F.sum("in_truth")).alias("pacc"))
    none = F.lit(None).cast("double")
    return each.select(F.col("cls").cast("int").alias("cls"), "acc", "iou", none.alias("fwiou"), none.alias("pacc")).unionByName(total.select(F.lit(None).cast("int").alias("cls"), "acc", "iou", "fwiou", "pacc"))


def claims(pairs: DataFrame, image: str, category: str, det: str, truth: str, threshold: float) -> DataFrame:
    """(category, det, score, tp) for the detections of (…, det, score, truth, iou, difficult) with null truths where one meets none.

    A detection looks at its best truth only; a truth counts once, for its highest score. Detections whose truth is difficult
    count neither way and are left out (without a column ``difficult`` no truth is).
    """
    hard = F.coalesce(F.col("difficult"), F.lit(False)) if "difficult" in pairs.columns else F.lit(False)
    best = pairs.groupBy(image, category, det, "score").agg(F.max_by(F.struct(truth, "iou", hard.alias("hard")), F.struct("iou", -F.col(truth))).alias("m"))
    best = best.select(image, category, det, "score", F.col(f"m.{truth}").alias(truth), F.coalesce(F.col("m.iou"), F.lit(0.0)).alias("iou"), F.coalesce(F.col("m.hard"), F.lit(False)).alias("hard"))
    hit = F.col("iou") > threshold
    best = best.where(~(hit & F.col("hard")))
    first = Window.partitionBy(image, category, truth, hit).orderBy(F.desc("score"), det)
    return best.withColumn("tp", (hit & (F.row_number().over(first) == 1)).cast("int")).select(category, det, "score", "tp")


def _curve(hits: DataFrame, keys: list[str], det: str) -> DataFrame:
    """(keys, det, score, tp, truths) with tps, seen, recall, precision and envelope, by falling score, then ``det``.

    Counts run within slices of the scores, and those of the slices above are added, so that a key is spread over as many
    tasks as it has slices; a row for each slice and key is all that a single task sorts. Equal scores share a slice.
    """
    part = [*keys, "slice"]
    rows = written(hits.withColumn("slice", F.floor(F.col("score") * SLICES)), "scores")
    above = Window.partitionBy(*keys).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*part).agg(F.sum("tp").alias("tps"), F.count("*").alias("seen"))
    before = sums.select(*part, *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("tps", "seen")])
    down = Window.partitionBy(*part).orderBy(F.desc("score"), det).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.join(before, part).withColumns({"tps": F.sum("tp").over(down) + F.col("tps_above"), "seen": F.count("*").over(down) + F.col("seen_above")})
    run = run.withColumns({"recall": F.col("tps") / F.col("truths"), "precision": F.col("tps") / F.col("seen")}).drop("tps_above", "seen_above")
    below = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = run.groupBy(*part).agg(F.max("precision").alias("top")).select(*part, F.max("top").over(below).alias("later"))
    back = Window.partitionBy(*part).orderBy(F.asc("score"), F.desc(det)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return run.join(tops, part).withColumn("envelope", F.greatest(F.max("precision").over(back), "later")).drop("slice", "later")


def precision_recall(claimed: DataFrame, truths: DataFrame, category: str, det: str) -> DataFrame:
    """Running precision and recall by falling score, and the precision's envelope from the right."""
    return _curve(claimed.join(truths, category), [category], det)


def average_precision(curve: DataFrame, category: str, det: str, eleven_points: bool = False) -> DataFrame:
    """(category, ap): area under the envelope, or the mean over eleven recalls."""
    if eleven_points:
        each = curve.withColumn("t", F.explode(F.array(*[F.lit(i / 10) for i in range(11)]))).where("recall >= t - 1e-12")
        return each.groupBy(category, "t").agg(F.max("precision").alias("p")).groupBy(category).agg((F.sum("p") / 11).alias("ap"))
    # Recall grows by one truth at each true positive.
    return curve.groupBy(category).agg(F.sum(F.col("tp") / F.col("truths") * F.col("envelope")).alias("ap"))


def _by_image(df: DataFrame, keys: list[str], each, schema) -> DataFrame:  # noqa: ANN001
    """``each`` (rows of one key, in a list of column lists) -> rows.

    Rows are dealt by key and sorted, and a task reads them batch by batch: it holds one batch and the rows of one key,
    whatever the table's size. How many partitions there are is left to the session and to Spark.
    """
    places = [df.columns.index(k) for k in keys]

    def same(a: list, b: list) -> bool:
        return all(x == y or x != x and y != y for x, y in zip(a, b, strict=True))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        now: list | None = None
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

        for part in parts:
            # Python's own numbers: ids of any size stay exact, also in columns with nulls.
            for row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                key = [row[i] for i in places]
                if now is None or not same(key, now):
                    if held:
                        rows += each(*map(list, zip(*held, strict=True)))
                    held, now = [], key
                held.append(row)
            if len(rows) > ROWS:
                yield out()
                rows = []
        if held:
            rows += each(*map(list, zip(*held, strict=True)))
        yield out()

    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kinds = to_arrow_schema(schema)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def greedy_matches(pairs: DataFrame, keys: list[str], det: str, truth: str, thresholds: list[float], areas: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(keys, det, score, area, threshold, place, tp): detections by falling score each take the best truth that is free.

    ``pairs`` has a row (keys, det, score, det_size, truth, truth_size, iou) for each pair that overlaps, and one with null truth for
    each detection that meets none. In each range of areas, ends included, detections take truths of that range before others; those
    that take another, or none and are out of range themselves, don't count and have no row. ``place`` is a detection's place by
    score within its key. Of equal overlaps the truth with the smallest id is taken. Without ``areas`` no sizes are needed.

    With a column ``crowd`` truths for which it is true stand for many: their ``iou`` is taken to be the share of the detection
    that they cover, any number of detections may take them, after all others, and those that do don't count.
    """
    ranges = areas or {"all": (0.0, 0.0)}
    levels = [(area, float(least)) for area in ranges for least in thresholds]
    kind = pairs.schema[det].dataType.simpleString()
    schema = ", ".join([*(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys), f"{det} {kind}", "score double", "area string", "threshold double", "place int", "tp int"])

    def each(*columns: list) -> list[tuple]:
        key = [c[0] for c in columns[: len(keys)]]
        return [
            (*key, d, score, *level, place, hits >> i & 1)
            for d, score, place, counts, hits in _taken(columns[len(keys) :], thresholds, list(ranges.values()))
            for i, level in enumerate(levels)
            if counts >> i & 1
        ]

    return _by_image(_to_match(pairs, keys, det, truth, areas), keys, each, schema)


def _to_match(pairs: DataFrame, keys: list[str], det: str, truth: str, areas: dict[str, tuple[float, float]] | None) -> DataFrame:
    sizes = [F.col(c) if areas else F.lit(0.0).alias(c) for c in ("det_size", "truth_size")]
    crowds = F.coalesce(F.col("crowd"), F.lit(False)) if "crowd" in pairs.columns else F.lit(False)
    return pairs.select(*keys, det, "score", sizes[0], truth, sizes[1], "iou", crowds.alias("crowd"))


def _taken(columns: list[list], thresholds: list[float], ranges: list[tuple[float, float]]) -> list[tuple]:
    """(det, score, place, counts, hits) of one key's detections by falling score: a bit for each range and, within it, each threshold."""
    found: dict = {}
    dets = {}
    for d, score, size, t, t_size, q, crowd in zip(*columns, strict=True):
        dets[d] = (score, size)
        if t is not None and q is not None and q >= min(thresholds):
            found.setdefault(d, []).append((q, t, t_size, crowd))
    order = sorted(dets.items(), key=lambda x: (-x[1][0], x[0]))
    counts, hits = dict.fromkeys(dets, 0), dict.fromkeys(dets, 0)
    for i, (low, high) in enumerate(ranges):
        first = i * len(thresholds)
        all_ = ((1 << len(thresholds)) - 1) << first
        for d, (_, size) in order:
            if low <= size <= high:
                counts[d] |= all_
        inside = lambda size: low <= size <= high  # noqa: B023, E731
        best = [(d, sorted(found[d], key=lambda x: (x[3] or not inside(x[2]), -x[0], x[1]))) for d, _ in order if d in found]
        for j, least in enumerate(thresholds):
            bit = 1 << first + j
            used: set = set()
            for d, of in best:
                hit = next(((t, inside(s) and not crowd) for q, t, s, crowd in of if q >= least and (crowd or t not in used)), None)
                if hit is not None:
                    used.add(hit[0])
                    counts[d] = counts[d] | bit if hit[1] else counts[d] & ~bit
                    hits[d] |= bit if hit[1] else 0
    return [(d, float(score), place, counts[d], hits[d]) for place, (d, (score, _)) in enumerate(order, 1)]


def greedy_levels(pairs: DataFrame, keys: list[str], det: str, truth: str, thresholds: list[float], areas: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(keys, det, score, place, counts, hits): the matches of :func:`greedy_matches` as one row a detection.

    ``counts`` has a bit for each range of areas and, within it, each threshold, in their order, set where the detection counts; ``hits``
    those at which it takes a truth. There are 63 at most.
    """
    ranges = areas or {"all": (0.0, 0.0)}
    if len(ranges) * len(thresholds) > 63:
        raise ValueError("there are 63 ranges and thresholds at most; greedy_matches takes any number")
    kind = pairs.schema[det].dataType.simpleString()
    schema = ", ".join([*(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys), f"{det} {kind}", "score double", "place int", "counts long", "hits long"])

    def each(*columns: list) -> list[tuple]:
        key = [c[0] for c in columns[: len(keys)]]
        return [(*key, *row) for row in _taken(columns[len(keys) :], thresholds, list(ranges.values()))]

    return _by_image(_to_match(pairs, keys, det, truth, areas), keys, each, schema)


def mask_overlaps(dets: DataFrame, truths: DataFrame, keys: list[str], det: str, truth: str, crowd: str | None = None, tile: int = 64) -> DataFrame:
    """(keys, det, truth, det_size, truth_size, iou) of the masks of each key that share cells.

    A mask is its runs of cells: rows (keys, id, r, c0, c1), ends included, that don't overlap within a mask. Runs are cut at multiples of
    ``tile`` columns, so that two pieces can only meet in their own row and tile. For truths whose ``crowd`` is true ``iou`` is the share
    of the detection that they cover.
    """
    size = lambda df, n, name: df.groupBy(*keys, n).agg(F.sum(F.col("c1") - F.col("c0") + 1).cast("double").alias(name))
    more = [crowd] if crowd else []

    def cut(df: DataFrame, id_: str, ends: tuple[str, str]) -> DataFrame:
        at = F.col("t") * tile
        t = df.withColumn("t", F.explode(F.sequence(F.floor(F.col("c0") / tile), F.floor(F.col("c1") / tile))))
        return t.select(*keys, "r", "t", id_, F.greatest("c0", at).alias(ends[0]), F.least("c1", at + (tile - 1)).alias(ends[1]))

    a, b = cut(dets, det, ("a0", "a1")), cut(truths, truth, ("b0", "b1"))
    met = a.join(b, [*keys, "r", "t"]).withColumn("n", F.least("a1", "b1") - F.greatest("a0", "b0") + 1).where("n > 0")
    shared = met.groupBy(*keys, det, truth).agg(F.sum("n").cast("double").alias("shared"))
    of_truth = size(truths, truth, "truth_size").join(truths.select(*keys, truth, *more).distinct(), [*keys, truth])
    out = shared.join(size(dets, det, "det_size"), [*keys, det]).join(of_truth, [*keys, truth])
    union = F.col("det_size") + F.col("truth_size") - F.col("shared")
    iou = F.col("shared") / (F.when(F.col(crowd), F.col("det_size")).otherwise(union) if crowd else union)
    return out.select(*keys, det, truth, "det_size", "truth_size", iou.alias("iou"), *more)


def keypoint_similarity(dets: DataFrame, truths: DataFrame, keys: list[str], det: str, truth: str, sigmas: list[float]) -> DataFrame:
    """(keys, det, truth, truth_size, iou): the similarity of key points of every detection and truth of a key, as in the COCO scores.

    Both have arrays ``xs`` and ``ys`` with a place for each of ``sigmas``; truths have ``vs`` (0: not labelled), ``truth_size`` and a box
    x0, y0, x1, y1 too. Without a labelled point the distance to the box, widened by its own size on each side, counts for all.
    """
    t = truths.select(*keys, truth, "truth_size", F.col("xs").alias("tx"), F.col("ys").alias("ty"), F.col("vs").alias("tv"), "x0", "y0", "x1", "y1")
    pairs = dets.select(*keys, det, "xs", "ys").join(t, keys)
    some = F.exists("tv", lambda v: v > 0)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    off = lambda x, low, high: F.greatest(low - x, F.lit(0.0)) + F.greatest(x - high, F.lit(0.0))
    each = F.transform(
        F.sequence(F.lit(0), F.lit(len(sigmas) - 1)),
        lambda i: F.struct(
            F.when(some, F.col("xs")[i] - F.col("tx")[i]).otherwise(off(F.col("xs")[i], F.col("x0") - w, F.col("x1") + w)).alias("dx"),
            F.when(some, F.col("ys")[i] - F.col("ty")[i]).otherwise(off(F.col("ys")[i], F.col("y0") - h, F.col("y1") + h)).alias("dy"),
            (F.lit(8.0) * F.array(*[F.lit(float(s)) for s in sigmas])[i] * F.array(*[F.lit(float(s)) for s in sigmas])[i]).alias("k"),
            (~some | (F.col("tv")[i] > 0)).alias("counts"),
        ),
    )
    counted = F.filter(each, lambda p: p["counts"])
    likeness = F.transform(counted, lambda p: F.exp(-(p["dx"] * p["dx"] + p["dy"] * p["dy"]) / (p["k"] * (F.col("truth_size") + F.lit(2.0**-52)))))
    total = F.aggregate(likeness, F.lit(0.0), lambda a, x: a + x)
    return pairs.select(*keys, det, truth, "truth_size", (total / F.size(counted)).alias("iou"))


def coco_precision(matches: DataFrame, truths: DataFrame, category: str, det: str, thresholds: list[float], limits: dict[str, list[int]]) -> DataFrame:
    """(category, area, most, threshold, ap, ar): precision at 101 recalls under the envelope, and the last recall.

    ``truths`` has (category, area, truths), ``limits`` the numbers of detections an image and category that count, by area.
    Categories with truths but without detections have 0, those without truths in an area no row.
    """
    most = F.explode(F.create_map(*[x for a, n in limits.items() for x in (F.lit(a), F.array(*[F.lit(k) for k in n]))])[F.col("area")])
    wanted = truths.withColumn("most", most).withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    keys = [category, "area", "most", "threshold"]
    run = _curve(matches.withColumn("most", most).where(F.col("place") <= F.col("most")).join(truths, [category, "area"]), keys, det)
    # A row is the first that reaches the recalls between the row before and itself; the first row reaches 0 too.
    steps = lambda recall: F.floor(recall * 100 + 1e-9)
    reached = steps(F.col("recall")) - steps((F.col("tps") - F.col("tp")) / F.col("truths")) + (F.col("seen") == 1).cast("int")
    run = run.withColumn("reached", reached)
    scores = run.groupBy(*keys).agg((F.sum(F.col("reached") * F.col("envelope")) / 101).alias("ap"), F.max("recall").alias("ar"))
    return wanted.join(scores, keys, "left").na.fill(0.0, ["ap", "ar"]).select(*keys, "ap", "ar")


def coco_precision_of_levels(matches: DataFrame, truths: DataFrame, category: str, det: str, thresholds: list[float], limits: dict[str, list[int]]) -> DataFrame:
    """The same from (category, det, score, place, counts, hits) of :func:`greedy_levels`, whose ranges of areas are those of ``limits``.

    A detection stays one row, whatever the numbers of thresholds, ranges and limits. Counts of the slices of scores above go ahead of
    a slice's rows; its task adds to them row by row and sends on the best precision at each of 101 recalls.
    """
    keys = [(area, i * len(thresholds) + j, k, float(t)) for i, area in enumerate(limits) for j, t in enumerate(thresholds) for k in limits[area]]
    bits, mosts = np.array([x[1] for x in keys]), np.array([x[2] for x in keys])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(x[1]).alias("bit"), F.lit(x[2]).alias("most"), F.lit(x[0]).alias("area"), F.lit(x[3]).alias("threshold")) for n, x in enumerate(keys)]))
    part = [category, "slice"]
    rows = written(matches.select(category, F.floor(F.col("score") * SLICES).alias("slice"), "score", det, "place", "counts", "hits").where("slice is not null"), "levels")
    # Few states within a slice, as few truths are met and places count by the limits they pass only.
    passed = sum((F.col("place") > k).cast("int") for k in sorted(set(mosts.tolist())))
    states = rows.groupBy(*part, "counts", "hits", passed.alias("passed")).agg(F.count("*").alias("n"), F.min("place").alias("place"))
    states = states.withColumn("k", each).where(F.col("place") <= F.col("k.most"))
    of = lambda c: F.sum(F.col("n") * F.expr(f"shiftright({c}, k.bit) & 1"))
    sums = states.groupBy(*part, F.col("k.n").alias("key")).agg(of("hits").alias("tps"), of("counts").alias("seen"))
    # A slice without a row at one of the limits has the counts above all the same.
    every = rows.select(*part).distinct().withColumn("k", each).select(*part, F.col("k.n").alias("key"), F.col("k.area").alias("area"))
    above = Window.partitionBy(category, "key").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    before = every.join(sums, [*part, "key"], "left").na.fill(0, ["tps", "seen"]).withColumns({c: F.coalesce(F.sum(c).over(above), F.lit(0)) for c in ("tps", "seen")})
    before = before.join(truths.select(category, "area", "truths"), [category, "area"], "left")
    heads = before.groupBy(*part).agg(F.sort_array(F.collect_list(F.struct("key", "tps", "seen", F.coalesce("truths", F.lit(0)).cast("long").alias("truths")))).alias("h"))
    heads = heads.select(*part, *[F.col(f"h.{c}").cast("array<long>").alias(f"{c}_above") for c in ("tps", "seen", "truths")])
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("is_row", F.col("counts").isNotNull())
    ordered = both.repartition(*part).sortWithinPartitions(*part, "is_row", F.desc("score"), det)
    kind = matches.schema[category].dataType
    schema = StructType().add(category, kind).add("key", "integer").add("step", "integer").add("precision", "double").add("recall", "double")
    kinds = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tps = seen = total = np.zeros(len(keys), np.int64)
        best: dict = {}

        def out() -> pa.RecordBatch:
            done = [(c, n, step, p, r) for (c, n, step), (p, r) in best.items()]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*done, strict=True) if done else [()] * len(kinds), kinds, strict=True)], schema=kinds)

        for batch in parts:
            cut = np.flatnonzero(~batch.column("is_row").to_numpy(zero_copy_only=False))
            ends = sorted({0, *cut.tolist(), batch.num_rows})
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                head = a in cut
                if head:
                    tps, seen, total = (np.array(batch.column(f"{c}_above")[a].as_py(), np.int64) for c in ("tps", "seen", "truths"))
                lines = batch.slice(a + head, b - a - head)
                if not lines.num_rows:
                    continue
                number = lambda c: lines.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[:, None]  # noqa: B023, E731
                within = number("place") <= mosts
                hit = ((number("hits") >> bits) & 1) * within
                hits, counts = tps + np.cumsum(hit, 0), seen + np.cumsum(((number("counts") >> bits) & 1) * within, 0)
                tps, seen = hits[-1], counts[-1]
                # Precision falls between true positives, so that the best at a recall is at one of them.
                at, n = np.nonzero(hit * (total > 0))
                precision, recall = hits[at, n] / counts[at, n], hits[at, n] / total[n]
                name = lines.column(category)[0].as_py()
                for k, step, p, r in zip(n.tolist(), np.floor(recall * 100 + 1e-9).astype(int).tolist(), precision.tolist(), recall.tolist(), strict=True):
                    old = best.get((name, k, step), (0.0, 0.0))
                    best[name, k, step] = (max(old[0], p), max(old[1], r))
                if len(best) > ROWS:
                    yield out()
        yield out()

    at = [category, "key", "step"]
    best = ordered.mapInArrow(run, schema).groupBy(*at).agg(F.max("precision").alias("precision"), F.max("recall").alias("recall"))
    curve = Window.partitionBy(category, "key").orderBy("step")
    envelope = F.max("precision").over(curve.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # A step stands for the recalls between the step before and itself; the first one for 0 too.
    reached = F.col("step") - F.coalesce(F.lag("step").over(curve), F.lit(-1))
    scores = best.withColumn("part", reached * envelope).groupBy(category, "key").agg((F.sum("part") / 101).alias("ap"), F.max("recall").alias("ar"))
    wanted = truths.select(category, "area").withColumn("k", each).where("area = k.area").select(category, "area", "k.most", "k.threshold", F.col("k.n").alias("key"))
    return wanted.join(scores, [category, "key"], "left").na.fill(0.0, ["ap", "ar"]).select(category, "area", "most", "threshold", "ap", "ar")


def panoptic_quality(pairs: DataFrame) -> DataFrame:
    """From (segment_category, isthing, pixel counts) PQ, SQ and RQ for all, things and stuff: a pair counts above IoU 0.5.

    ``pairs`` has truth, pred (null where there is none), category, isthing, both, in_truth and in_pred.
    """
    iou = F.col("both") / (F.col("in_truth") + F.col("in_pred") - F.col("both"))
    hit = pairs.where("truth is not null and pred is not null").withColumn("iou", iou).where("iou > 0.5")
    tp = hit.groupBy("category", "isthing").agg(F.sum("iou").alias("iou"), F.count("*").alias("tp"))
    seen = lambda c, n: pairs.where(f"{c} is not null").groupBy("category", "isthing").agg(F.count_distinct(c).alias(n))
    each = seen("truth", "truths").join(seen("pred", "preds"), ["category", "isthing"], "full").join(tp, ["category", "isthing"], "left").na.fill(0, ["truths", "preds", "tp", "iou"])
    each = each.withColumns({"sq": F.when(F.col("tp") > 0, F.col("iou") / F.col("tp")).otherwise(0.0), "rq": 2 * F.col("tp") / (F.col("truths") + F.col("preds"))})
    means = each.withColumn("pq", F.col("sq") * F.col("rq")).groupingSets([["isthing"], []], "isthing").agg(F.avg("pq").alias("pq"), F.avg("sq").alias("sq"), F.avg("rq").alias("rq"), F.expr("grouping(isthing)").alias("g"))
    kind = F.when(F.col("g") == 1, "all").when(F.col("isthing") == 1, "things").otherwise("stuff")
    return means.select(kind.alias("kind"), "pq", "sq", "rq")


def suppressed(boxes: DataFrame, keys: list[str], id_: str, threshold: float) -> DataFrame:
    """Boxes that stay after greedy suppression, by falling score, of those that overlap a kept one by more than ``threshold``.

    A key is an image and class; its boxes are compared with the kept ones only.
    """
    names = [f.name for f in boxes.schema]
    at = {n: names.index(n) for n in (id_, "score", "x0", "y0", "x1", "y1")}

    def each(*columns: list) -> list[tuple]:
        kept: list[tuple] = []
        for row in sorted(zip(*columns, strict=True), key=lambda r: (-r[at["score"]], r[at[id_]])):
            x0, y0, x1, y1 = (row[at[n]] for n in ("x0", "y0", "x1", "y1"))
            for other in kept:
                u0, v0, u1, v1 = (other[at[n]] for n in ("x0", "y0", "x1", "y1"))
                w, h = min(x1, u1) - max(x0, u0), min(y1, v1) - max(y0, v0)
                if w > 0 and h > 0 and w * h > threshold * ((x1 - x0) * (y1 - y0) + (u1 - u0) * (v1 - v0) - w * h):
                    break
            else:
                kept.append(row)
        return kept

    return _by_image(boxes, keys, each, boxes.schema)


def suppressed_rotated(boxes: DataFrame, keys: list[str], id_: str, threshold: float) -> DataFrame:
    """The same for rotated boxes: cx, cy, w, h and angle in degrees. Classes are kept apart by naming them in ``keys``."""
    names = [f.name for f in boxes.schema]
    at = {n: names.index(n) for n in (id_, "score", "cx", "cy", "w", "h", "angle")}
    shape = lambda row: tuple(row[at[n]] for n in ("cx", "cy", "w", "h", "angle"))

    def each(*columns: list) -> list[tuple]:
        kept: list[tuple] = []
        for row in sorted(zip(*columns, strict=True), key=lambda r: (-r[at["score"]], r[at[id_]])):
            a, reach = shape(row), (row[at["w"]] ** 2 + row[at["h"]] ** 2) ** 0.5 / 2
            for other in kept:
                b = shape(other)
                far = reach + (b[2] ** 2 + b[3] ** 2) ** 0.5 / 2
                if abs(a[0] - b[0]) < far and abs(a[1] - b[1]) < far and rotated_iou(a, b) > threshold:
                    break
            else:
                kept.append(row)
        return kept

    return _by_image(boxes, keys, each, boxes.schema)


def accuracy(pred: Column, truth: Column, background: int) -> dict[str, Column]:
    """Aggregates: share of right classes, of right ones among foreground truth, and of foreground truth called background."""
    fg = truth != background
    return {
        "accuracy": F.avg((pred == truth).cast("double")),
        "fg_accuracy": F.avg(F.when(fg, (pred == truth).cast("double"))),
        "false_negative": F.avg(F.when(fg, (pred == background).cast("double"))),
    }


def proposal_recall(pairs: DataFrame, truths: DataFrame, keys: list[str], det: str, truth: str, thresholds: list[float], limits: list[int], areas: dict[str, tuple[float, float]]) -> DataFrame:
    """(area, most, threshold, recall): of each range of truths' areas, ends included, those that a proposal covers; threshold null: the mean.

    Each proposal covers one truth, best pairs first. ``pairs`` has (keys, det, score, truth, truth_size, iou), and a row of each
    proposal of an image with truths; of an image's proposals the ``most`` best count. ``truths`` has (truth, truth_size).
    """
    ranked = pairs.withColumn("_k", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("score"), det)))

    def each(*columns: list) -> list[tuple]:
        key = [c[0] for c in columns[: len(keys)]]
        order = sorted(zip(*columns[len(keys) :], strict=True), key=lambda x: (-x[3], x[0], x[1]))
        rows = []
        for area, (low, high) in areas.items():
            for most in limits:
                used_d, used_t = set(), set()
                for d, t, size, q, k in order:
                    if k <= most and low <= size <= high and d not in used_d and t not in used_t:
                        used_d.add(d)
                        used_t.add(t)
                        rows.append((*key, area, most, t, q))
        return rows

    schema = ", ".join([*(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys), "area string", "most int", f"{truth} long", "iou double"])
    covered = _by_image(ranked.where("iou > 0").select(*keys, det, truth, "truth_size", "iou", "_k"), keys, each, schema).select("area", "most", truth, "iou")
    ranges = F.array(*[F.struct(F.lit(n).alias("area"), F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high")) for n, (a, b) in areas.items()])
    sized = truths.withColumn("_a", F.explode(ranges)).where(F.col("truth_size").between(F.col("_a.low"), F.col("_a.high")))
    total = sized.groupBy(F.col("_a.area").alias("area")).agg(F.count("*").alias("truths"))
    # A truth has a row for each pair of area and number that covers it; the others are counted only.
    met = covered.join(truths.select(truth, "truth_size"), truth).withColumn("_a", F.explode(ranges))
    met = met.where("area = _a.area").where(F.col("truth_size").between(F.col("_a.low"), F.col("_a.high")))
    hit = met.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))).where("iou >= threshold")
    hits = hit.groupBy("area", "most", "threshold").agg(F.count("*").alias("hits"))
    every = total.withColumn("most", F.explode(F.array(*[F.lit(n) for n in limits]))).withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    both = every.join(hits, ["area", "most", "threshold"], "left").na.fill(0, ["hits"])
    recall = (F.sum("hits") / F.sum("truths")).alias("recall")
    return both.groupingSets([["area", "most", "threshold"], ["area", "most"]], "area", "most", "threshold").agg(recall).select("area", "most", "threshold", "recall")


def best_proposals(boxes: DataFrame, image: str, level: str, id_: str, before: int, threshold: float, after: int, least_side: float) -> DataFrame:
    """The ``before`` best of each image and level, without small and non-finite ones, suppressed by level; then the ``after`` best of an image."""
    from geoledger.functions.boxes import box, is_finite

    best = Window.partitionBy(image, level).orderBy(F.desc("score"), id_)
    wide = (F.col("x1") - F.col("x0") > least_side) & (F.col("y1") - F.col("y0") > least_side)
    some = boxes.withColumn("_k", F.row_number().over(best)).where((F.col("_k") <= before) & wide & is_finite(*box())).drop("_k")
    order = Window.partitionBy(image).orderBy(F.desc("score"), id_)
    return suppressed(some, [image, level], id_, threshold).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= after).drop("_k")


def federated_precision(dets: DataFrame, truths: DataFrame, pairs: DataFrame, negatives: DataFrame, partial: DataFrame, image: str, category: str, det: str, truth: str, thresholds: list[float], most: int = 300) -> DataFrame:
    """(category, ap): mean precision over the thresholds where an image is judged for some categories only.

    An image is judged for the categories of its truths and those that ``negatives`` (image, category) lists as not there; detections of
    others don't count. Of an image's detections, whatever their category, the ``most`` best count. Where ``partial`` (image, category) says
    that not all truths are marked, a detection that takes none doesn't count. ``dets`` has (image, category, det, score), ``truths``
    (image, category, truth), ``pairs`` (det, truth, iou) of each pair of an image and category that overlaps. Rows with a null image or
    category don't count; repeated rows of the last three tables count once.
    """
    place = F.row_number().over(Window.partitionBy(image).orderBy(F.desc("score"), det))
    best = dets.select(image, category, det, "score").withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    key = [image, category]
    judged = best.join(truths.select(*key).union(negatives.select(*key)).distinct(), key, "left_semi")
    met = judged.join(pairs.select(det, truth, "iou").distinct(), det, "left")
    found = greedy_levels(met, key, det, truth, thresholds)
    open_ = partial.select(*key).distinct().withColumn("_open", F.lit(True))
    counted = found.join(open_, key, "left").withColumn("counts", F.when(F.col("_open"), F.col("hits")).otherwise(F.col("counts"))).drop("_open")
    counts = truths.where(F.col(category).isNotNull() & F.col(image).isNotNull()).groupBy(category).agg(F.count_distinct(truth).alias("truths")).withColumn("area", F.lit("all"))
    scores = coco_precision_of_levels(counted, counts, category, det, thresholds, {"all": [most]})
    return scores.groupBy(category).agg(F.avg("ap").alias("ap"))


def by_frequency(scores: DataFrame, images: DataFrame, category: str, rare: int = 10, common: int = 100) -> DataFrame:
    """(frequency, ap): mean of the categories' scores by how many images have them: r, c or f; and of all."""
    kind = F.when(F.col("images") <= rare, "r").when(F.col("images") <= common, "c").otherwise("f")
    named = scores.join(images, category).withColumn("frequency", kind)
    sums = named.groupingSets([["frequency"], []], "frequency").agg(F.avg("ap").alias("ap"), F.expr("grouping(frequency)").alias("g"))
    return sums.select(F.when(F.col("g") == 1, "all").otherwise(F.col("frequency")).alias("frequency"), "ap")


def with_super_categories(matrix: DataFrame, groups: dict[int, str]) -> DataFrame:
    """(level, name, iou) of classes and of their super-categories, from a confusion table (pred, truth, n)."""
    names = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv])
    sup = lambda c: F.try_element_at(names, F.col(c).cast("int"))
    levels = matrix.select(F.lit("class").alias("level"), F.col("pred").cast("string").alias("p"), F.col("truth").cast("string").alias("t"), "n").unionByName(matrix.select(F.lit("group").alias("level"), sup("pred").alias("p"), sup("truth").alias("t"), "n"))
    sides = levels.select("level", F.explode(F.array(F.struct(F.col("p").alias("name"), F.lit(0).alias("side")), F.struct(F.col("t").alias("name"), F.lit(1).alias("side")))).alias("s"), (F.col("p") == F.col("t")).alias("same"), "n")
    sums = sides.groupBy("level", F.col("s.name").alias("name")).agg(F.sum("n").alias("both"), F.sum(F.when(F.col("same") & (F.col("s.side") == 0), F.col("n")).otherwise(0)).alias("tp"))
    return sums.select("level", "name", (F.col("tp") / (F.col("both") - F.col("tp"))).alias("iou"))


def _inner(cells: DataFrame, value: str, across: str, along: str, width: int) -> DataFrame:
    """Cells with ``width`` cells of their class on both sides in their row (or column): one scan, whatever the width."""
    line = Window.partitionBy("scene_id", across, value)
    runs = cells.withColumn("_g", F.col(along) - F.row_number().over(line.orderBy(along)))
    run = Window.partitionBy("scene_id", across, value, "_g")
    ends = runs.withColumns({"_a": F.min(along).over(run), "_b": F.max(along).over(run)})
    return ends.where((F.col(along) - F.col("_a") >= width) & (F.col("_b") - F.col(along) >= width)).select("scene_id", "r", "c", value)


def band_width(height: int, width: int, share: float = 0.02) -> int:
    """Cells in ``share`` of the diagonal of a scene, at least one."""
    return max(1, round(share * (height**2 + width**2) ** 0.5))


def boundary_cells(cells: DataFrame, value: str, width: int = 1) -> DataFrame:
    """Cells of a class within ``width`` cells, also at an angle, of another class or of none: a mask less its erosion by a square.

    The inner cells are found by a scan of rows and one of columns.
    """
    own = cells.select("scene_id", "r", "c", value)
    inner = _inner(_inner(own, value, "r", "c", width), value, "c", "r", width)
    return own.join(inner.select("scene_id", "r", "c"), ["scene_id", "r", "c"], "left_anti")


def best_detections(boxes: DataFrame, image: str, category: str, id_: str, least_score: float, threshold: float, k: int, width: float, height: float) -> DataFrame:
    """Boxes above a score, clipped to the image, suppressed within their class, and the k best of each image."""
    from geoledger.functions.boxes import box, clipped, is_finite, is_not_empty

    cut = dict(zip(("x0", "y0", "x1", "y1"), clipped(box(), width, height), strict=True))
    some = boxes.where((F.col("score") > least_score) & is_finite(*box())).withColumns(cut).where(is_not_empty(box()))
    kept = suppressed(some, [image, category], id_, threshold)
    order = Window.partitionBy(image).orderBy(F.desc("score"), id_)
    return kept.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).drop("_k")


def merged_segments(masks: DataFrame, semantic: DataFrame, most_overlap: float, least_area: int) -> DataFrame:
    """(scene_id, kind, id, cells): instances by falling score claim free cells, then stuff classes what is left.

    ``masks`` has (scene_id, instance, score, r, c), ``semantic`` (scene_id, r, c, cls). An instance of whose cells more than the
    share ``most_overlap`` are claimed goes; stuff of fewer than ``least_area`` cells goes. A scene's masks are in one group.
    """
    cell = (F.col("r") * F.lit(1 << 20) + F.col("c")).cast("long")

    def each(scenes: list, instances: list, scores: list, cells: list) -> list[tuple]:
        of: dict = {}
        for i, s, c in zip(instances, scores, cells, strict=True):
            of.setdefault((-s, i), set()).add(c)
        taken: set = set()
        rows = []
        for (_, i), own in sorted(of.items()):
            free = own - taken
            if len(own) - len(free) <= most_overlap * len(own) and free:
                taken |= free
                rows += [(scenes[0], i, c) for c in free]
        return rows

    scene = masks.schema["scene_id"].dataType.simpleString()
    claimed = _by_image(masks.select("scene_id", "instance", "score", cell.alias("cell")), ["scene_id"], each, f"scene_id {scene}, instance long, cell long")
    things = claimed.groupBy("scene_id", F.lit("thing").alias("kind"), F.col("instance").alias("id")).agg(F.count("*").alias("cells"))
    rest = semantic.withColumn("cell", cell).join(claimed.select("scene_id", "cell"), ["scene_id", "cell"], "left_anti")
    stuff = rest.groupBy("scene_id", F.lit("stuff").alias("kind"), F.col("cls").cast("long").alias("id")).agg(F.count("*").alias("cells")).where(F.col("cells") >= least_area)
    return things.unionByName(stuff)
