"""Centre lines of regions and the graph that they make: ends and junctions are vertices, the chains between them edges.

Tables of cells have scene_id, r, c; r and c are below 2^20. Repeated cells count once, cells with nulls are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from geoledger.operators.graph import connected_components
from geoledger.operators.layers import _douglas_peucker
from geoledger.scratch import drop_written, written

#: The eight neighbours, clockwise from the north; a neighbour's bit is its place here.
AROUND = [(-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1)]
_ROW = 1 << 20
_SCENE = 1 << 40


def with_neighbours(cells: DataFrame) -> DataFrame:
    """(scene_id, r, c, around): cells with a bit for each neighbour that is there. One shuffle: each cell is sent to its neighbours."""
    places = [(0, 0, 0), *[(-dy, -dx, 1 << k) for k, (dy, dx) in enumerate(AROUND)]]
    to = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(bit).alias("bit")) for dy, dx, bit in places]))
    sent = cells.select("scene_id", "r", "c", to.alias("d"))
    at = sent.groupBy("scene_id", (F.col("r") + F.col("d.dy")).alias("r"), (F.col("c") + F.col("d.dx")).alias("c"))
    return at.agg(F.bit_or("d.bit").alias("around"), F.bool_or(F.col("d.bit") == 0).alias("here")).where("here").drop("here")


def _goes(near: dict[str, Column], turn: int) -> Column:
    """The bits of cells that go in the first or second turn of a round of Guo and Hall's thinning (1989); a bit is a cell."""
    n, ne, e, se, s, sw, w, nw = (near[k] for k in ("n", "ne", "e", "se", "s", "sw", "w", "nw"))
    not_, either, both = F.bitwise_not, (lambda x, y: x.bitwiseOR(y)), (lambda x, y: x.bitwiseAND(y))
    two = lambda a, b, c, d: either(either(both(a, b), both(c, d)), both(either(a, b), either(c, d)))
    four = lambda a, b, c, d: both(both(a, b), both(c, d))
    parts = [both(not_(n), either(ne, e)), both(not_(e), either(se, s)), both(not_(s), either(sw, w)), both(not_(w), either(nw, n))]
    odd = parts[0].bitwiseXOR(parts[1]).bitwiseXOR(parts[2]).bitwiseXOR(parts[3])
    one = both(odd, not_(two(*parts)))
    first, second = [either(nw, n), either(ne, e), either(se, s), either(sw, w)], [either(n, ne), either(e, se), either(s, sw), either(w, nw)]
    # The smaller of the two numbers is 2 or 3.
    sides = both(both(two(*first), two(*second)), not_(both(four(*first), four(*second))))
    held = both(either(either(s, sw), not_(nw)), w) if turn == 0 else both(either(either(n, ne), not_(se)), e)
    return both(both(one, sides), not_(held))


def _turned(words: DataFrame, turn: int) -> DataFrame:
    """Words of cells (scene_id, r, w, bits) after a turn. One shuffle: each word is sent to the places around, those beside it get its edge."""
    top = -(1 << 63)
    edge = {0: F.col("bits"), 1: F.shiftrightunsigned("bits", 63), -1: F.shiftleft("bits", 63)}
    sent = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dw).alias("dw"), edge[dw].alias("x")) for dr in (-1, 0, 1) for dw in (-1, 0, 1)])
    sent = words.select("scene_id", "r", "w", F.explode(F.filter(sent, lambda d: d["x"] != 0)).alias("d"))
    at = sent.groupBy("scene_id", (F.col("r") + F.col("d.dr")).alias("r"), (F.col("w") + F.col("d.dw")).alias("w"))
    rows = {"north": 1, "own": 0, "south": -1}
    of = lambda dr, beside: F.coalesce(F.bit_or(F.when((F.col("d.dr") == dr) & ((F.col("d.dw") != 0) == F.lit(beside)), F.col("d.x"))), F.lit(0).cast("long"))
    met = at.agg(*[of(dr, beside).alias(f"{name}{int(beside)}") for name, dr in rows.items() for beside in (False, True)]).where("own0 != 0")
    near = {}
    for name, (west, middle, east) in {"north": ("nw", "n", "ne"), "own": ("w", "", "e"), "south": ("sw", "s", "se")}.items():
        row, beside = F.col(f"{name}0"), F.col(f"{name}1")
        near[west], near[middle], near[east] = F.shiftleft(row, 1).bitwiseOR(beside.bitwiseAND(F.lit(1).cast("long"))), row, F.shiftrightunsigned(row, 1).bitwiseOR(beside.bitwiseAND(F.lit(top)))
    return met.select("scene_id", "r", "w", near[""].bitwiseAND(F.bitwise_not(_goes(near, turn))).alias("bits")).where("bits != 0")


def thinned(cells: DataFrame) -> DataFrame:
    """The centre lines, one cell wide, of all regions; what hangs together still does.

    64 cells of a row are the bits of a word, so that a row is a word of cells at most. Rounds of two shuffles each, as many as
    half of the widest region's width, with the words left written between them.
    """
    words = cells.select("scene_id", "r", "c").dropna().groupBy("scene_id", "r", F.shiftright("c", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(c & 63 as int)))").alias("bits"))
    total = lambda df: df.agg(F.sum(F.bit_count("bits"))).first()[0] or 0
    now = written(words, "thin")
    n = total(now)
    while True:
        left = written(_turned(_turned(now, 0), 1), "thin")
        was, n = n, total(left)
        drop_written(now)
        now = left
        if was == n:
            break
    kind = cells.schema["c"].dataType
    bit = F.explode(F.expr("filter(sequence(0, 63), k -> shiftrightunsigned(bits, k) & 1 = 1)"))
    return now.select("scene_id", "r", "w", bit.alias("k")).select("scene_id", F.col("r").cast(cells.schema["r"].dataType).alias("r"), (F.col("w") * 64 + F.col("k")).cast(kind).alias("c"))


def line_graph(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, edges, members) of thinned cells.

    ``vertices`` (scene_id, id, r, c, degree): cells that haven't two neighbours. ``edges`` (scene_id, edge, a, b, cells): chains of
    cells with two neighbours each, by their first cell, and the vertices at their ends (both null: a ring); vertices that
    touch are joined by an edge without cells and without a number. ``members`` (edge, r, c): the cells of the chains.
    """
    id_ = F.col("scene_id") * _SCENE + F.col("r") * _ROW + F.col("c")
    near = written(with_neighbours(lines).select("scene_id", "r", "c", "around", id_.cast("long").alias("id"), F.bit_count("around").alias("degree")), "centre")
    # Half of the directions, so that each pair comes once.
    ahead = F.explode(F.filter(F.array(*[F.struct(F.lit(1 << k).alias("bit"), F.lit(AROUND[k][0] * _ROW + AROUND[k][1]).alias("step")) for k in range(2, 6)]), lambda d: F.col("around").bitwiseAND(d["bit"]) != 0))
    pairs = near.select("scene_id", "id", "degree", ahead.alias("d")).select("scene_id", "id", "degree", (F.col("id") + F.col("d.step")).alias("other"))
    pairs = written(pairs.join(near.select(F.col("id").alias("other"), F.col("degree").alias("other_degree")), "other"), "pairs")
    inner, far = F.col("degree") == 2, F.col("other_degree") == 2
    chains = connected_components(pairs.where(inner & far).select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "id")
    members = written(near.where(inner).join(chains, "id", "left").select("scene_id", "id", "r", "c", F.coalesce("component", "id").alias("edge")), "chains")
    ends = pairs.where(inner & ~far).select("id", F.col("other").alias("v")).unionByName(pairs.where(~inner & far).select(F.col("other").alias("id"), F.col("id").alias("v")))
    touched = ends.join(members.select("id", "edge"), "id").groupBy("edge").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    edges = members.groupBy("scene_id", "edge").agg(F.count("*").alias("cells")).join(touched, "edge", "left").select("scene_id", "edge", "a", "b", "cells")
    direct = pairs.where(~inner & ~far).select("scene_id", F.lit(None).cast("long").alias("edge"), F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), F.lit(0).cast("long").alias("cells"))
    return near.where(~inner).select("scene_id", "id", "r", "c", "degree"), edges.unionByName(direct), members.select("edge", "r", "c")


def lines_of(edges: DataFrame, members: DataFrame, tolerance: float) -> DataFrame:
    """(scene_id, edge, points): each chain's centres in order from the end ``a``, with its vertices, simplified; a ring ends where it begins.

    A chain is a row: it has no more cells than its scene's grid lets a line have. Edges without cells aren't drawn.
    """
    place = lambda v: None if v is None else (v % _SCENE // _ROW, v % _ROW)

    def drawn(a: tuple[int, int] | None, b: tuple[int, int] | None, cells: list[dict]) -> list[dict]:
        left = {(p["r"], p["c"]) for p in cells}
        at = min(p for p in left if a is None or max(abs(p[0] - a[0]), abs(p[1] - a[1])) == 1)
        path = [at]
        left.discard(at)
        while left:
            at = min(p for p in ((at[0] + dy, at[1] + dx) for dy, dx in AROUND) if p in left)
            path.append(at)
            left.discard(at)
        path = [*path, path[0]] if a is None else [a, *path, b]
        points = _douglas_peucker(np.array([(c + 0.5, r + 0.5) for r, c in path]), tolerance)
        return [{"x": x, "y": y} for x, y in points.tolist()]

    schema = "scene_id long, edge long, points array<struct<x:double,y:double>>"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scene, edge, a, b, cells = (part.column(k) for k in range(5))
            points = [drawn(place(x), place(y), p) for x, y, p in zip(a.to_pylist(), b.to_pylist(), cells.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([scene, edge, pa.array(points, kinds.field("points").type)], schema=kinds)

    known = edges.where("edge is not null").select(F.col("scene_id").cast("long").alias("scene_id"), "edge", F.col("a").cast("long"), F.col("b").cast("long"))
    held = members.groupBy("edge").agg(F.collect_list(F.struct("r", "c")).alias("cells"))
    return known.join(held, "edge").select("scene_id", "edge", "a", "b", "cells").mapInArrow(each, schema)
