"""Scoring with a user's model, and work on whole tiles: spectra, equalisation, panoptic merging, trackers, rotated boxes.

A tile, a tile pair or an image is a row or a small group, so that work is spread by rows; numpy works inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from geoledger.functions.classes import binary_mask


def scored(df: DataFrame, features: str, make_model: Callable[[], Callable], shape: list[int], batch: int = 16, out: str = "scores") -> DataFrame:
    """``df`` with the scores of a model that is made once per worker and called on batches of 1 to 64 rows of the given shape."""
    if not 1 <= batch <= 64:
        raise ValueError("a batch has 1 to 64 rows")
    model = predict_batch_udf(make_model, return_type=ArrayType(FloatType()), batch_size=batch, input_tensor_shapes=[shape])
    return df.withColumn(out, model(F.col(features)))


def changed(first: Column, second: Column | None = None) -> Column:
    """1 where either model's score is change."""
    one = binary_mask(first)
    return one if second is None else one.bitwiseOR(binary_mask(second))


def averaged(df: DataFrame, grid: str, model: Callable[[np.ndarray], np.ndarray], out: str) -> DataFrame:
    """``df`` with the mean score of the eight turned and mirrored forms of each square grid, turned back."""

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            means = []
            for rows in part[grid]:
                x = np.array([list(r) for r in rows], float)
                turned = [np.rot90(m, k) for k in range(4) for m in (x, x.T)]
                back = [np.rot90(model(t), -(i // 2)) for i, t in enumerate(turned)]
                means.append(np.mean([b.T if i % 2 else b for i, b in enumerate(back)], 0).tolist())
            yield part.assign(**{out: means})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + f", {out} array<array<double>>"
    return df.mapInPandas(each, schema)


def low_frequencies_of(pre: np.ndarray, post: np.ndarray) -> np.ndarray:
    """``pre`` with the four lowest frequencies of ``post``: what passes 255 becomes the largest value of ``pre``, all is cut to whole numbers.

    The block's place is taken from the height for both axes.
    """
    a, b = np.fft.fftshift(np.fft.fft2(pre)), np.fft.fftshift(np.fft.fft2(post))
    k = pre.shape[0] // 2
    a[k - 1 : k + 1, k - 1 : k + 1] = b[k - 1 : k + 1, k - 1 : k + 1]
    out = np.abs(np.fft.ifft2(np.fft.ifftshift(a)))
    out[out > 255] = pre.max()
    return out.astype(np.int32)


def equalised(band: np.ndarray, clip: float = 2.0, grid: int = 8) -> np.ndarray:
    """Contrast-limited adaptive equalisation of an 8-bit band: a curve for each part of a grid, blended between their centres."""
    h, w = band.shape
    rows, cols = np.array_split(np.arange(h), min(grid, h)), np.array_split(np.arange(w), min(grid, w))
    curves = np.empty((len(rows), len(cols), 256))
    for i, r in enumerate(rows):
        for j, c in enumerate(cols):
            n = np.bincount(band[np.ix_(r, c)].ravel(), minlength=256).astype(float)
            most = max(1.0, clip * n.sum() / 256)
            over = np.clip(n - most, 0, None).sum()
            curves[i, j] = np.cumsum(np.minimum(n, most) + over / 256) * 255 / n.sum()
    at = lambda parts, n: np.clip(np.interp(np.arange(n), [p.mean() for p in parts], np.arange(len(parts))), 0, len(parts) - 1)
    y, x = at(rows, h)[:, None], at(cols, w)[None, :]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, len(rows) - 1), np.minimum(x0 + 1, len(cols) - 1)
    fy, fx = y - y0, x - x0
    blend = (1 - fy) * (1 - fx) * curves[y0, x0, band] + (1 - fy) * fx * curves[y0, x1, band] + fy * (1 - fx) * curves[y1, x0, band] + fy * fx * curves[y1, x1, band]
    return np.round(blend).astype(np.int32)


def by_tile(cells: DataFrame, size: int, bands: list[str], change: Callable[..., np.ndarray]) -> DataFrame:
    """(scene_id, r, c, v): ``change`` of the bands' arrays of each tile of ``size`` cells; cells that aren't there are 0."""
    at = lambda c: F.floor(F.col(c) / F.lit(float(size)))
    dealt = cells.withColumns({"_y": at("r"), "_x": at("c")})

    def each(df: pd.DataFrame) -> pd.DataFrame:
        y, x = int(df["_y"].iloc[0]) * size, int(df["_x"].iloc[0]) * size
        r, c = df["r"].to_numpy() - y, df["c"].to_numpy() - x
        arrays = []
        for b in bands:
            a = np.zeros((size, size), np.int64)
            a[r, c] = df[b]
            arrays.append(a)
        return pd.DataFrame({"scene_id": df["scene_id"], "r": df["r"], "c": df["c"], "v": change(*arrays)[r, c]})

    return dealt.groupBy("scene_id", "_y", "_x").applyInPandas(each, "scene_id long, r long, c long, v int")


@lru_cache(4096)
def _axis(degrees: float) -> tuple[float, float]:
    # Rounded, so that right angles are exact.
    cos, sin = np.round((np.cos(np.radians(degrees)), np.sin(np.radians(degrees))), 15)
    return float(cos), float(sin)


def corners(cx: float, cy: float, w: float, h: float, degrees: float) -> list[tuple[float, float]]:
    """The four corners of a rotated box, in turn. Plain numbers, as arrays of two cost more than the work on them."""
    cos, sin = _axis(degrees)
    w, h = w / 2, h / 2
    return [(x * cos + y * sin + cx, y * cos - x * sin + cy) for x, y in ((-w, -h), (w, -h), (w, h), (-w, h))]


def _turn(a: tuple[float, float], b: tuple[float, float], c: tuple[float, float]) -> float:
    """Above 0 where the way from a over b to c turns left."""
    return (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])


def rotated_iou(a: tuple, b: tuple) -> float:
    """IoU of two rotated boxes (centre, size, degrees), by cutting one with the other."""
    from geoledger.operators.layers import _cut_points

    p, q = corners(*a), corners(*b)
    cut = _cut_points(p, q if _turn(q[0], q[1], q[2]) > 0 else q[::-1])
    both = abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(cut, cut[1:] + cut[:1], strict=True))) / 2 if len(cut) >= 3 else 0.0
    return both / (a[2] * a[3] + b[2] * b[3] - both) if both > 0 else 0.0


def with_rotated_iou(pairs: DataFrame, a: list[str], b: list[str]) -> DataFrame:
    """Pairs with ``iou`` of two rotated boxes given by five columns each."""

    @F.pandas_udf("double")
    def iou(boxes: pd.DataFrame) -> pd.Series:
        return pd.Series([rotated_iou(r[:5], r[5:]) for r in boxes.itertuples(index=False, name=None)])

    # Deterministic functions run again in each filter and column that uses them.
    return pairs.withColumn("iou", iou.asNondeterministic()(F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate([*a, *b])])))


def rotated_pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rotated boxes (cx, cy, w, h, angle) that agree in the keys and whose upright hulls meet, as aliases a and b, with iou."""
    from geoledger.functions.boxes import hull
    from geoledger.operators.overlay import overlapping

    def hulls(df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(("x0", "y0", "x1", "y1"), hull(*[F.col(c) for c in _FIVE]), strict=True)))

    return with_rotated_iou(overlapping(hulls(left), hulls(right), keys), [f"a.{c}" for c in _FIVE], [f"b.{c}" for c in _FIVE])


_FIVE = ("cx", "cy", "w", "h", "angle")


def assigned(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, each row and column once (the Hungarian method with potentials)."""
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0, way = i, 0, np.zeros(m + 1, int)
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = owner[j0]
            free = ~used[1:]
            new = c[i0 - 1] - u[i0] - v[1:]
            better = free & (new < least[1:])
            least[1:][better] = new[better]
            way[1:][better] = j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            step = least[j1]
            u[owner[used]] += step
            v[used] -= step
            least[~used] -= step
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0], j0 = owner[way[j0]], way[j0]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return sorted((b, a) if flip else (a, b) for a, b in pairs)


def assigned_above(gain: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs (row, column) of at least ``least`` gain: as many as can be, and of those the ones of most gain in all.

    Rows and columns that no such pair links don't matter to each other, so that each linked group is assigned by itself.
    """
    rows, columns = (x.tolist() for x in np.nonzero(gain >= least))
    of_row: dict[int, list[int]] = {}
    of_column: dict[int, list[int]] = {}
    for i, j in zip(rows, columns, strict=True):
        of_row.setdefault(i, []).append(j)
        of_column.setdefault(j, []).append(i)
    pairs, seen = [], set()
    for first in of_row:
        if first in seen:
            continue
        group, other, todo = {first}, set(), [first]
        while todo:
            for j in of_row[todo.pop()]:
                if j not in other:
                    other.add(j)
                    new = [i for i in of_column[j] if i not in group]
                    group.update(new)
                    todo += new
        seen |= group
        if len(group) == 1 or len(other) == 1:
            pairs.append(min(((i, j) for i in sorted(group) for j in sorted(other)), key=lambda p: -gain[p]))
            continue
        at, to = sorted(group), sorted(other)
        part = gain[np.ix_(at, to)]
        pairs += [(at[i], to[j]) for i, j in assigned(np.where(part >= least, -part, 1e5)) if part[i, j] >= least]
    return sorted(pairs)


def _iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.clip(np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0]), 0, None)
    h = np.clip(np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1]), 0, None)
    size = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    both = w * h
    return np.where(both > 0, both / np.maximum(size(a)[:, None] + size(b)[None, :] - both, 1e-12), 0.0)


def follow(live: list, fresh: int, now: np.ndarray, least: float, lost_frames: int, least_period: int, method: str) -> tuple[list[int], list, int]:
    """(track of each of the boxes ``now``, live tracks after the frame, number of the next track).

    A live track is [track, box, age in frames, frames lost].
    """
    iou = _iou_matrix(now, np.array([t[1] for t in live])) if live else np.zeros((len(now), 0))
    if method == "iou":
        pairs = list(zip(*np.nonzero(iou >= least), strict=True))
    else:
        pairs = assigned_above(iou, least) if iou.size else []
    got, used = {}, set()
    for i, j in pairs:
        if i not in got and j not in used:
            got[i] = j
            used.add(j)
    new, tracks = [], []
    for i, box in enumerate(now):
        if i in got:
            track, period = live[got[i]][0], live[got[i]][2] + 1
        else:
            track, period, fresh = fresh, 1, fresh + 1
        new.append([track, box, period, 0])
        tracks.append(track)
    return tracks, new + [[t, b, p, lost + 1] for j, (t, b, p, lost) in enumerate(live) if j not in used and lost < lost_frames and p >= least_period], fresh


def tracked(boxes: DataFrame, video: str, frame: str, id_: str, least: float = 0.5, lost_frames: int = 2, least_period: int = 1, method: str = "iou") -> DataFrame:
    """(video, frame, id, track): boxes followed from frame to frame.

    ``iou`` takes pairs of at least ``least`` in the order of their places, each box and track once; ``assignment`` takes the pairs of
    least cost, with IoU as gain. Other boxes begin tracks. A track that isn't found is kept for ``lost_frames`` if it is
    ``least_period`` frames old. Boxes are dealt by video and sorted; a task reads them one after the other and holds a frame
    and the live tracks only.
    """
    kind = lambda n: boxes.schema[n].dataType.simpleString()
    columns = [video, frame, id_, "track"]

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        state: tuple = (None, [], 0)  # video, live tracks, next track

        def close() -> list[tuple]:
            nonlocal state
            if state[0] != now[0]:
                state = (now[0], [], 0)
            tracks, live, fresh = follow(state[1], state[2], np.array([h[1:] for h in held], float), least, lost_frames, least_period, method)
            state = (now[0], live, fresh)
            return [(*now, h[0], t) for h, t in zip(held, tracks, strict=True)]

        for df in parts:
            rows: list[tuple] = []
            for v, f, *box in df[[video, frame, id_, "x0", "y0", "x1", "y1"]].itertuples(index=False, name=None):
                if (v, f) != now:
                    if held:
                        rows += close()
                    now, held = (v, f), []
                held.append(box)
            yield pd.DataFrame(rows, columns=columns)
        if held:
            yield pd.DataFrame(close(), columns=columns)

    ordered = boxes.select(video, frame, id_, "x0", "y0", "x1", "y1").repartition(video).sortWithinPartitions(video, frame, id_)
    return ordered.mapInPandas(each, f"{video} {kind(video)}, {frame} {kind(frame)}, {id_} {kind(id_)}, track long")
