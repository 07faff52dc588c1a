"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Equal vectors are one class. Vectors are divided by their largest component and then by their length, so that no finite one
is too small or too large. Each tree splits the space again and again along random directions at the median of a
bounded sample; vectors near a split go to both sides. Vectors are compared with those in their leaf only, and a pair that
shares several leaves counts in the first alone. Products are taken in single precision first; those within its error
of the bound are taken again in double precision. A leaf of too many vectors is cut into
blocks, and each pair of blocks is a task of its own, so that a dense cluster is spread.

No pairs are sent on: each comparison gives a vector's number of links and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.llm.simhash import _Forest
from geoledger.operators.graph import connected_components
from geoledger.scratch import written

#: Trees at least; vectors a leaf has at about which splitting stops; vectors of a block; rows that splits are fitted on at most.
TREES, LEAF, BLOCK, SAMPLE = 6, 1000, 3000, 20_000
#: Levels of a tree at least, so that a small table has smaller leaves and not another way.
LEVELS = 3
#: Vectors so near to a split (times 1 / sqrt of the dimension) go to both sides.
SPILL = 0.16
#: Of the pairs near the bound so many stay together at a level, and so many may be missed by all trees.
TOGETHER, MISSED = 0.89, 0.01
_PAIRS = 1 << 18


def depth_for(n: int) -> int:
    return max(LEVELS, int(np.ceil(np.log2(n / LEAF))))


def trees_for(depth: int) -> int:
    """Trees by depth, as a pair that is parted at any level is lost in that tree."""
    return max(TREES, int(np.ceil(np.log(MISSED) / np.log(1 - TOGETHER**depth))))


class Forest:
    """Directions by tree and level, and each node's threshold; nodes that the sample says nothing of split at the level's median."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth, self.margin = depth, SPILL / max(1, sample.shape[1]) ** 0.5
        self.directions = [self._spread(rng.standard_normal((sample.shape[1], depth))) for _ in range(trees)]
        self.thresholds = [self._fit(sample @ d) for d in self.directions]

    @staticmethod
    def _spread(d: np.ndarray) -> np.ndarray:
        """Unit length, and at right angles to each other as far as there are dimensions."""
        width = d.shape[0]
        parts = [np.linalg.qr(d[:, k : k + width])[0] for k in range(0, d.shape[1], width)]
        return np.concatenate(parts, 1) if parts else d

    def _fit(self, p: np.ndarray) -> list[tuple[dict[int, float], float]]:
        node, out = np.zeros(len(p), np.int64), []
        for level in range(self.depth):
            values, common = {}, float(np.median(p[:, level])) if len(p) else 0.0
            order = np.argsort(node, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                if len(part) >= 8:
                    values[int(node[part[0]])] = float(np.median(p[part, level]))
            out.append((values, common))
            node = node * 2 + (p[:, level] > self._at(node, values, common))
        return out

    @staticmethod
    def _at(node: np.ndarray, values: dict[int, float], common: float) -> np.ndarray:
        known, back = np.unique(node, return_inverse=True)
        return np.array([values.get(int(n), common) for n in known])[back] if len(node) else np.empty(0)

    def cells(self, x: np.ndarray) -> list[np.ndarray]:
        """The leaves of each row: first its own of each tree, then those that it spills into, each in ascending order."""
        if not len(x):
            return []
        rows, cells, homes = [], [], []
        for tree, (d, thresholds) in enumerate(zip(self.directions, self.thresholds, strict=True)):
            p, row, node, home = x @ d, np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
            for level, (values, common) in enumerate(thresholds):
                away = p[row, level] - self._at(node, values, common)
                left, right = away <= self.margin, away > -self.margin
                home = np.concatenate((home[left] & (away[left] <= 0), home[right] & (away[right] > 0)))
                row, node = np.concatenate((row[left], row[right])), np.concatenate((node[left] * 2, node[right] * 2 + 1))
            rows.append(row)
            cells.append(node + (tree << self.depth))
            homes.append(home)
        row, cell = np.concatenate(rows), np.concatenate(cells)
        order = np.lexsort((cell, ~np.concatenate(homes), row))
        return np.split(cell[order], np.cumsum(np.bincount(row, minlength=len(x)))[:-1])


def _unit(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _table(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of different lengths as rows of one array, filled up with -1."""
    lists = column.combine_chunks()
    length = np.diff(lists.offsets.to_numpy())
    out = np.full((len(length), int(length.max(initial=1))), -1, np.int64)
    out[np.arange(out.shape[1]) < length[:, None]] = lists.flatten().to_numpy()
    return out


def _first_common(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, cell: int, trees: int) -> np.ndarray:
    """Which pairs (i, j) of rows of the cell tables ``a`` and ``b`` have no common cell before ``cell``."""
    left = np.arange(len(i))
    for t in range(trees):  # most pairs that met before did so in the leaf that is their own in some tree
        now = a[i[left], t]
        left = left[(now != b[j[left], t]) | (now >= cell)]
    for column in a.T:
        if not len(left):
            break
        now = column[i[left]]
        met = ((b[j[left]] == now[:, None]).any(1)) & (now < cell)
        left = left[~met]
    return left


def compare(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray, wx: np.ndarray, wy: np.ndarray, same: bool, cell: int, least: float, trees: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(links of each row of x then y, root of each in the same numbering), over the pairs that meet first in ``cell``."""
    n = len(x)
    links, forest = np.zeros(n + (0 if same else len(y)), np.int64), _Forest(n + (0 if same else len(y)))
    off = 0 if same else n
    step = max(1, (1 << 22) // max(1, len(y)))
    single, turned = x.astype(np.float32), y.astype(np.float32).T
    error = (x.shape[1] + 8) * 2.0**-23
    for k in range(0, n, step):
        near = single[k : k + step] @ turned
        i, j = np.nonzero(near >= least - error)
        unsure = near[i, j] < least + error
        i += k
        if same:
            one = i < j
            i, j, unsure = i[one], j[one], unsure[one]
        for s in range(0, len(i), _PAIRS):
            a, b, u = i[s : s + _PAIRS], j[s : s + _PAIRS], np.flatnonzero(unsure[s : s + _PAIRS])
            fine = np.ones(len(a), bool)
            fine[u] = np.einsum("ij,ij->i", x[a[u]], y[b[u]]) >= least
            a, b = a[fine], b[fine]
            new = _first_common(cx, cy, a, b, cell, trees)
            a, b = a[new], b[new]
            links += np.bincount(a, wy[b], len(links)).astype(np.int64) + np.bincount(b + off, wx[a], len(links)).astype(np.int64)
            forest.join(a, b + off)
    return links, forest.roots(np.arange(len(links)))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row per row of ``vectors``.

    Vectors that are null, empty, zero, or hold a null or a non-finite component link with nothing. Vectors of different
    lengths don't link; each length has its own forest, of at least three levels. The splits of lengths of at most ``LEAF``
    vectors are fitted on one sample of them all, or go through the origin where it holds none. Repeated rows are other
    vectors. Null ids are passed over in ``component_id``. An empty table gives an empty result; other columns don't matter.
    """
    # Single precision, if the table has it, takes half of the place on the way.
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    good = F.col(vector_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(good, v).alias("v"))
    rows = rows.select("id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("k"))
    classes = written(rows.where("v is not null").groupBy("k").agg(F.first("v").alias("v"), F.count("*").alias("w"), F.min("id").alias("first")), "vectors")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    taken = lambda part, few: [r["v"] for r in part.orderBy(F.xxhash64("k"), "k").limit(few).select("v").collect()]
    fitted = {dim: taken(classes.where(F.size("v") == dim), max(LEAF, SAMPLE * n // sum(sizes.values()))) for dim, n in sizes.items() if n > LEAF}
    if len(fitted) < len(sizes):
        for v in taken(classes.where(~F.size("v").isin(list(fitted))), SAMPLE):
            fitted.setdefault(len(v), []).append(v)
    forests = {}
    for dim, n in sizes.items():
        sample = _unit(pa.array(fitted.get(dim, []), pa.list_(pa.float64())), dim)
        forests[dim] = Forest(sample, depth_for(n), trees_for(depth_for(n)))
    small = max((len(f.directions) << f.depth for f in forests.values()), default=0) < 1 << 31

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = np.diff(b.column(1).offsets.to_numpy())
            for dim in np.unique(length).tolist():
                part = b.filter(pa.array(length == dim))
                cells = pa.array(forests[dim].cells(_unit(part.column(1), dim)), pa.list_(pa.int32() if small else pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, cells, pa.array([dim] * part.num_rows, pa.int32())], names=["k", "v", "w", "cells", "dim"])

    placed = classes.select("k", "v", "w").mapInArrow(place, f"k long, v array<{kind}>, w long, cells array<{'int' if small else 'long'}>, dim int")
    placed = written(placed, "cells")
    dealt = placed.select("k", "v", "w", "cells", "dim", F.explode("cells").alias("cell"))
    full = placed.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = dealt.join(full, ["dim", "cell"]).withColumn("own", F.pmod(F.xxhash64("k", F.lit(3)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})

    def each(t: pa.Table) -> pa.Table:
        p, q, cell = (t.column(c)[0].as_py() for c in ("p", "q", "cell"))
        x, k, w, own = _unit(t.column("v"), t.column("dim")[0].as_py()), t.column("k").to_numpy(), t.column("w").to_numpy(), t.column("own").to_numpy()
        dim, table = t.column("dim")[0].as_py(), _table(t.column("cells"))
        # Padding must not match: it differs between the two sides.
        a, b = np.flatnonzero(own == p), np.flatnonzero(own == q)
        padded = np.where(table < 0, -2, table)
        links, root = compare(x[a], x[b], table[a], padded[b], w[a], w[b], p == q, cell, least, len(forests[dim].directions))
        key = k[a] if p == q else np.concatenate((k[a], k[b]))
        hit = links > 0
        return pa.table({"k": key[hit], "links": links[hit], "root": key[root[hit]]})

    found = dealt.select("dim", "cell", "p", "q", "own", "k", "v", "w", "cells").groupBy("dim", "cell", "p", "q").applyInArrow(each, "k long, links long, root long")
    found = written(found, "links")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    tied = connected_components(found.select(F.col("k").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "k")
    member = written(classes.select("k", "w", "first").join(links, "k", "left").join(tied, "k", "left").withColumn("component", F.coalesce("component", "k")), "members")
    heads = member.groupBy("component").agg(F.min("first").alias("component_id"))
    label = member.join(heads, "component").select("k", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "k").join(label, "k", "left")
    component = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
