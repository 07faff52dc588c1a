"""Places for a user's own functions: steps over a layer, rows, label files, and a table function from polygons to cells."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

Step = Callable[[DataFrame], DataFrame]


def finished(raw: DataFrame, *steps: Step | None) -> DataFrame:
    """A layer after the steps (say fill, smooth, clip) in turn; absent ones are passed over, and ``raw`` stays as it is."""
    for step in steps:
        raw = raw.transform(step) if step else raw
    return raw


def mapped_rows(records: DataFrame, change: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """``change`` of each record as a dictionary; records for which it gives None go."""

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = (change(r) for r in part.to_dict("records"))
            yield pd.DataFrame([m for m in made if m is not None], columns=names)

    names = [f.name for f in records.sparkSession.createDataFrame([], schema).schema]
    return records.mapInPandas(each, schema)


def loaded_labels(files: DataFrame, load: Callable[[bytes], list[list[int]]]) -> DataFrame:
    """(path, r, c, v): cells of label files (path, content), decoded by the user's function, a file at a time."""

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                yield pd.DataFrame([(path, r, c, v) for r, row in enumerate(load(bytes(content))) for c, v in enumerate(row)], columns=["path", "r", "c", "v"])

    return files.select("path", "content").mapInPandas(each, "path string, r long, c long, v long")


@udtf(returnType="r bigint, c bigint")
class PolygonCells:
    """The cells of the unit grid whose centres are in a polygon, by the even-odd rule over its rings; row by row."""

    def eval(self, rings: list) -> Iterator[tuple[int, int]]:
        sides = [(ring[i], ring[i + 1]) for ring in rings or [] for i in range(len(ring) - 1)]
        ys = [p["y"] for side in sides for p in side]
        for r in range(math.floor(min(ys)), math.ceil(max(ys))) if ys else ():
            y = r + 0.5
            cuts = sorted(p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]) for p, q in sides if (p["y"] > y) != (q["y"] > y))
            for x0, x1 in zip(cuts[::2], cuts[1::2], strict=True):
                for c in range(math.ceil(x0 - 0.5), math.ceil(x1 - 0.5)):
                    yield r, c


def polygon_cells(polygons: DataFrame, rings: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with (r, c) of each cell that a polygon covers, by :class:`PolygonCells` as a lateral table function."""
    spark = polygons.sparkSession
    spark.udtf.register("polygon_cells", PolygonCells)
    return spark.sql(f"select {', '.join('p.' + k for k in keep)}, t.r, t.c from {{p}} p, lateral polygon_cells(p.{rings}) t", p=polygons)
