"""Exact top-k search by inner product: a ball tree in each shard, searched by branch and bound.

Vectors are routed to shards by the splits of one tree fitted on a bounded sample, so that a shard is a region; shards of too
many vectors are dealt further by a hash. Each shard becomes a ball tree: a node has a centre and a radius, and no
vector below it can have a greater product with a query than ``q . centre + |q| * radius``.

A query goes through the shards in the order of that bound of their roots, in a few passes: its best shard, the next few, then
all that are left whose bound reaches the kth score found so far. That score is shared between passes, and within a task
between the nodes of the tree: nodes are opened in the order of their bounds, and those below it are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.centroids import scaled
from geoledger.scratch import written

#: Vectors of a shard and of a leaf, queries of a task and of a step within it, vectors that the shards' splits are fitted on.
SHARD, LEAF, QUERIES, STEP, SAMPLE = 16_384, 128, 8192, 1024, 20_000
#: Shards that a query visits in each pass; the last takes all that are left.
PASSES = (1, 8, None)
#: Roots that a task compares with queries.
ROOTS = 4096
#: Up to this, sums of products of integers are exact in doubles.
EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer arrays, held within the limits of a long."""
    largest = [int(np.abs(x).max(initial=0)) for x in (a, b)]
    if max(1, a.shape[1]) * largest[0] * largest[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.array([[min(max(sum(map(int.__mul__, x, y)), _LEAST), _MOST) for y in b.tolist()] for x in a.tolist()], np.int64).reshape(len(a), len(b))


def _floats(x: np.ndarray) -> np.ndarray:
    return np.array([[float(v) if abs(v) < 1 << 1000 else math.copysign(1e300, v) for v in row] for row in x.tolist()]).reshape(x.shape) if x.dtype == object else x.astype(np.float64)


class BallTree:
    """A complete binary tree in heap order over integer vectors; its leaves are ranges of ``order``."""

    def __init__(self, x: np.ndarray, leaf: int | None = None):
        f, n = _floats(x), len(x)
        depth = max(0, math.ceil(math.log2(max(1, n) / (leaf or LEAF))))
        self.order, spans = np.arange(n), [(0, n)]
        for node in range((1 << depth) - 1):
            lo, hi = spans[node]
            part = self.order[lo:hi]
            # Between two points that are far from each other, at the median.
            far = f[part[((f[part] - f[part].mean(0)) ** 2).sum(1).argmax()]] if len(part) else 0
            other = f[part[((f[part] - far) ** 2).sum(1).argmax()]] if len(part) else 0
            self.order[lo:hi] = part[np.argsort(f[part] @ (other - far), kind="stable")] if len(part) else part
            spans += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
        self.spans, self.first_leaf = np.array(spans), (1 << depth) - 1
        self.centre, self.radius = np.zeros((len(spans), x.shape[1])), np.full(len(spans), -1.0)
        with np.errstate(over="ignore", invalid="ignore"):
            for node, (lo, hi) in enumerate(spans):
                if hi > lo:
                    part = f[self.order[lo:hi]]
                    self.centre[node] = part.mean(0)
                    self.radius[node] = np.sqrt(((part - self.centre[node]) ** 2).sum(1).max())

    def bounds(self, q: np.ndarray, norm: np.ndarray, node: np.ndarray) -> np.ndarray:
        return upper_bounds(np.einsum("ij,ij->i", q, self.centre[node]), norm, np.sqrt((self.centre[node] ** 2).sum(1)), self.radius[node])

    def search(self, queries: np.ndarray, kth: np.ndarray, k: int, score: object) -> int:
        """Branch and bound for all ``queries`` at once; ``kth`` falls due as ``score(query numbers, leaf)`` raises it.

        Returns the number of pairs of a query and a vector that were compared.
        """
        f = _floats(queries)
        norm, compared = np.sqrt((f**2).sum(1)), 0
        q, node = np.arange(len(f)), np.zeros(len(f), np.int64)
        bound = self.bounds(f, norm, node)
        opened = 1
        while len(q):
            alive = bound >= kth[q]
            q, node, bound = q[alive], node[alive], bound[alive]
            # Each query opens its nodes of the greatest bounds, more of them as the search goes on.
            order = np.lexsort((node, -bound, q))
            q, node, bound = q[order], node[order], bound[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            now = rank < opened
            at_leaf = now & (node >= self.first_leaf)
            leaf_q, leaf_node = q[at_leaf], node[at_leaf]
            for leaf in np.unique(leaf_node):
                asking = leaf_q[leaf_node == leaf]
                compared += len(asking) * int(self.spans[leaf, 1] - self.spans[leaf, 0])
                score(asking, leaf)
            inner = now & ~at_leaf
            iq = np.repeat(q[inner], 2)
            child = np.repeat(node[inner], 2) * 2 + 1 + np.tile([0, 1], int(inner.sum()))
            full = self.radius[child] >= 0
            iq, child = iq[full], child[full]
            q, node, bound = np.concatenate((q[~now], iq)), np.concatenate((node[~now], child)), np.concatenate((bound[~now], self.bounds(f[iq], norm[iq], child)))
            opened = min(opened * 2, 64) if at_leaf.any() else opened
        return compared


def upper_bounds(dot: np.ndarray, norm: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """At least the greatest product of a query with a vector of a ball, rounding included; within the limits of a long."""
    with np.errstate(over="ignore", invalid="ignore"):
        reach = norm * (centre + radius)
        bound = dot + norm * radius + reach * 1e-9 + 1.0
    return np.where(np.isfinite(bound), np.maximum(bound, float(_LEAST)), np.inf)


class _Best:
    """The k best (score, id) of each query so far; ties go to smaller ids, null ids last."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), _LEAST, np.int64), np.full((n, k), -1, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        """``score`` of each of the queries ``q`` with the vectors ``at`` (-1: none), whose ids order like ``rank``."""
        k = self.score.shape[1]
        s, i = np.concatenate((self.score[q], score), 1), np.concatenate((self.id[q], at), 1)
        place = np.where(i < 0, np.iinfo(np.int64).max, np.append(rank, 0)[i])
        # ~s turns the order round without overflow.
        order = np.lexsort((place, ~s, i < 0))[:, :k]
        self.score[q], self.id[q] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), np.float64).reshape(len(column), dim)


def _splits(sample: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(a direction, thresholds by node) for each level: medians of a sample."""
    rng = np.random.default_rng(11)
    directions = rng.standard_normal((depth, sample.shape[1]))
    node, thresholds = np.zeros(len(sample), np.int64), []
    for level in range(depth):
        p = sample @ directions[level]
        thresholds.append(np.array([np.median(p[node == k]) if (node == k).any() else 0.0 for k in range(1 << level)]))
        node = node * 2 + (p > thresholds[-1][node])
    return directions, thresholds


def _region(x: np.ndarray, splits: tuple[np.ndarray, list[np.ndarray]]) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    for d, t in zip(*splits, strict=True):
        node = node * 2 + (x @ d > t[node])
    return node


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component and length; zeros stay."""
    x = x / np.maximum(np.abs(x).max(1, keepdims=True, initial=0), 5e-324)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 5e-324)


def _shards(rows: DataFrame, number_type: str) -> DataFrame:
    """``rows`` (uid, id, v, dim) with the shard of each."""
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    total, splits = sum(sizes.values()), {}
    for dim, n in sizes.items():
        depth = max(0, math.ceil(math.log2(n / SHARD)))
        few = max(1000, SAMPLE * n // total)
        sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("uid")).limit(few).select("v").collect() if depth else []
        # Splits of more regions than the sample can tell apart are left to the hash below.
        depth = min(depth, max(0, int(math.log2(max(1, len(sample)) / 8)))) if depth else 0
        splits[dim] = _splits(_unit(np.array([r["v"] for r in sample], np.float64).reshape(len(sample), dim)), depth)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = np.asarray(b.column(3))
            for dim in np.unique(length).tolist():
                part = b.filter(pa.array(length == dim))
                x = np.asarray(part.column(2).flatten(), np.float64).reshape(part.num_rows, dim)
                region = _region(_unit(x), splits[dim]) if dim else np.zeros(part.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(region)], names=["uid", "id", "v", "dim", "region"])

    routed = written(rows.mapInArrow(route, f"uid long, id {number_type}, v {rows.schema['v'].dataType.simpleString()}, dim int, region long"), "routed")
    full = routed.groupBy("dim", "region").agg(F.ceil(F.count("*") / SHARD).alias("parts"))
    dealt = routed.join(full, ["dim", "region"]).withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")))
    return dealt.select("dim", F.concat_ws("-", "region", "part").alias("shard"), "uid", "id", "v")


def _trees(shards: DataFrame, k: int, scale: int, number_type: str, vector_type: str) -> DataFrame:
    """A row for each node of each shard's ball tree; leaves hold their vectors.

    Of equal vectors the first k + 1 ids are enough: no query can have more of them in its k best, its own row left out.
    """

    def build(t: pa.Table) -> pa.Table:
        dim = t.column("dim")[0].as_py()
        t = t.sort_by([("id", "ascending"), ("uid", "ascending")])
        x = _matrix(t.column("v"), dim)
        same = np.unique(x, axis=0, return_inverse=True)[1].reshape(-1) if dim else np.zeros(len(t), np.int64)
        order = np.argsort(same, kind="stable")
        ahead = np.arange(len(order)) - np.searchsorted(same[order], same[order])
        keep = np.sort(order[ahead <= k])
        tree = BallTree(scaled(x[keep], scale))
        t = t.take(pa.array(keep[tree.order]))
        nodes = len(tree.radius)
        size = np.where(np.arange(nodes) >= tree.first_leaf, tree.spans[:, 1] - tree.spans[:, 0], 0)
        ends = np.concatenate(([0], np.cumsum(size)))
        columns = {c: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), t.column(c).combine_chunks()) for c in ("uid", "id")}
        columns["v"] = pa.ListArray.from_arrays(pa.array(ends * dim, pa.int32()), t.column("v").combine_chunks().flatten())
        centres = pa.ListArray.from_arrays(pa.array(np.arange(nodes + 1) * dim, pa.int32()), pa.array(tree.centre.reshape(-1)))
        one = {"dim": pa.array([dim] * nodes, pa.int32()), "shard": pa.array([t.column("shard")[0].as_py()] * nodes, pa.string()), "node": pa.array(range(nodes), pa.int32())}
        return pa.table({**one, **columns, "centre": centres, "radius": tree.radius})

    schema = f"dim int, shard string, node int, uid array<long>, id array<{number_type}>, v {vector_type}, centre array<double>, radius double"
    return shards.groupBy("dim", "shard").applyInArrow(build, schema)


def _loaded(t: pa.Table, scale: int) -> tuple[BallTree, np.ndarray, np.ndarray, pa.Array]:
    """(tree, integer vectors, uids, ids) of the rows of a shard."""
    t = t.sort_by("node").combine_chunks()
    dim, nodes = t.column("dim")[0].as_py(), len(t)
    columns = {c: t.column(c).combine_chunks() for c in ("uid", "id", "v", "centre")}
    tree = BallTree.__new__(BallTree)
    tree.radius, tree.first_leaf = t.column("radius").to_numpy(), nodes // 2
    tree.centre = columns["centre"].flatten().to_numpy().reshape(nodes, dim)
    ends = np.cumsum(pc.list_value_length(columns["uid"]).to_numpy())
    tree.spans = np.stack((np.concatenate(([0], ends[:-1])), ends), 1)
    tree.order = np.arange(int(ends[-1]))
    x = np.asarray(columns["v"].flatten(), np.float64).reshape(len(tree.order), dim)
    return tree, scaled(x, scale), columns["uid"].flatten().to_numpy(), columns["id"].flatten()


def _due(asking: DataFrame, roots: DataFrame, most: int | None, scale: int) -> DataFrame:
    """(query, shard, bound) of the shards that each query visits next.

    Those come after its last one in the order of bounds, and may hold a score of its kth or more. ``asking`` has (query,
    dim, v, kth, after, last): the kth score and the bound and shard visited last, or null.
    """
    groups = {r["dim"]: -(-r["count"] // ROOTS) for r in roots.groupBy("dim").count().collect()}
    spread = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])[F.col("dim")]
    dealt_roots = roots.withColumn("group", F.pmod(F.xxhash64("shard"), spread))
    dealt = asking.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), spread.cast("long") - 1)))
    block = F.pmod(F.xxhash64("query"), F.lit(max(1, -(-asking.count() // QUERIES)))).alias("block")
    dealt = dealt.select("*", block)
    blocks = asking.select("dim", block).distinct()
    dealt_roots = dealt_roots.join(blocks, "dim")

    def bounds(left: pa.Table, right: pa.Table) -> pa.Table:
        dim, out = left.column("dim")[0].as_py(), []
        if len(right):
            q, c = _floats(scaled(_matrix(left.column("v"), dim), scale)), _matrix(right.column("centre"), dim)
            radius, shard = np.array(right.column("radius")), np.array(right.column("shard").to_pylist(), object)
            norm, size = np.sqrt((q**2).sum(1)), np.sqrt((c**2).sum(1))
            by_name = np.argsort(np.argsort(shard))
            for i in range(len(q)):
                # Summed row by row, so that a bound is the same in every pass, whatever rows are beside it.
                b = upper_bounds((c * q[i]).sum(1), norm[i], size, radius)
                kth, after, last = (left.column(x)[i].as_py() for x in ("kth", "after", "last"))
                fit = np.ones(len(b), bool) if kth is None else b >= kth
                if after is not None:
                    fit &= (b < after) | (b == after) & (shard > last)
                at = np.flatnonzero(fit)
                if most is not None:
                    at = at[np.lexsort((by_name[at], -b[at]))[:most]]
                out.append((np.full(len(at), left.column("query")[i].as_py()), shard[at], b[at]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "shard": pa.array(columns[1], pa.string()), "bound": pa.array(columns[2], pa.float64())})

    both = dealt.groupBy("dim", "group", "block").cogroup(dealt_roots.groupBy("dim", "group", "block"))
    found = both.applyInArrow(bounds, "query long, shard string, bound double")
    if most is None:
        return found
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "shard")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).drop("nth")


def _visit(visits: DataFrame, queries: DataFrame, trees: DataFrame, k: int, scale: int, number_type: str) -> DataFrame:
    """(query, uid, id, score): the k best of each query in each shard that it visits, from its kth score on."""
    asked = visits.select("query", "shard").join(queries, "query")
    blocks = visits.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).alias("blocks"))
    asked = asked.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).drop("blocks")
    searched = trees.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            ids = pa.array([], right.schema.field("id").type.value_type)
            return pa.table({"query": pa.array([], pa.int64()), "uid": pa.array([], pa.int64()), "id": ids, "score": pa.array([], pa.int64())})
        tree, x, uid, ids = _loaded(right, scale)
        rank = np.empty(len(uid), np.int64)
        rank[pc.sort_indices(pa.table({"i": ids, "u": uid}), [("i", "ascending"), ("u", "ascending")]).to_numpy()] = np.arange(len(uid))
        q, own = scaled(_matrix(left.column("v"), x.shape[1]), scale), left.column("query").to_numpy()
        kth = np.array([-np.inf if s is None else float(s) for s in left.column("kth").to_pylist()])
        out = []
        for a in range(0, len(q), STEP):
            part, mine, due, best = q[a : a + STEP], own[a : a + STEP], kth[a : a + STEP].copy(), _Best(len(q[a : a + STEP]), k)

            def score(asking: np.ndarray, leaf: int, part: np.ndarray = part, mine: np.ndarray = mine, due: np.ndarray = due, best: _Best = best) -> None:
                lo, hi = tree.spans[leaf]
                s = products(part[asking], x[lo:hi])
                at = np.where(uid[lo:hi] == mine[asking, None], -1, np.arange(lo, hi))
                best.add(asking, s, at, rank)
                due[asking] = np.maximum(due[asking], np.where(best.id[asking, -1] < 0, -np.inf, best.score[asking, -1].astype(np.float64)))

            tree.search(part, due, k, score)
            row, col = np.nonzero(best.id >= 0)
            at = best.id[row, col]
            out.append((mine[row], at, best.score[row, col]))
        query, at, s = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"query": query, "uid": uid[at], "id": ids.take(pa.array(at)), "score": s})

    both = asked.groupBy("shard", "dim", "block").cogroup(searched.groupBy("shard", "dim", "block"))
    return both.applyInArrow(search, f"query long, uid long, id {number_type}, score long")


def search(vectors: DataFrame, queries: F.Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, id_col, score): the ``k`` rows with the greatest inner products for each row for which ``queries`` is true.

    Components are taken as floor(scale * x), products are exact; beyond a long they are given (and ranked) as its limits.
    A query's own row is left out, other rows of the same id aren't. Ties go to smaller ids, null ids come last. Vectors that are
    null or hold a null or non-finite component take no part, and those of different lengths don't meet. Repeated
    rows count each, as candidates and as queries. With fewer rows than ``k`` all are returned; an empty table gives an
    empty result. Other columns don't matter. The passes run while the result is being built.
    """
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.where(good).select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), v.alias("v"), F.size(v).alias("dim"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = written(rows, "rows")
    asking = rows.where("asks").select(F.col("uid").alias("query"), F.col("id").alias("query_id"), "dim", "v")
    plain = rows.drop("asks")
    trees = written(_trees(_shards(plain, id_type), k, scale, id_type, f"array<{kind}>"), "trees")
    roots = trees.where("node = 0").select("dim", "shard", "centre", "radius")
    empty = "query long, uid long, id " + id_type + ", score long"
    found = rows.sparkSession.createDataFrame([], empty)
    if not roots.isEmpty():
        state = asking.select("query", "dim", "v", F.lit(None).cast("long").alias("kth"), F.lit(None).cast("double").alias("after"), F.lit(None).cast("string").alias("last"))
        for most in PASSES:
            visits = written(_due(state, roots, most, scale), "visits")
            new = _visit(visits, state.select("query", "v", "kth", "dim"), trees, k, scale, id_type)
            order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "uid")
            found = written(found.unionByName(new).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "found")
            if most is not None:
                kth = found.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
                edge = visits.groupBy("query").agg(F.min("bound").alias("after"), F.max_by("shard", F.struct(-F.col("bound"), "shard")).alias("last"))
                # Who had no shard left before has none now: its edge stays.
                old = state.select("query", "dim", "v", F.col("after").alias("a"), F.col("last").alias("l"))
                state = old.join(kth, "query", "left").join(edge, "query", "left")
                state = written(state.select("query", "dim", "v", "kth", F.coalesce("after", "a").alias("after"), F.when(F.col("after").isNull(), F.col("l")).otherwise(F.col("last")).alias("last")), "state")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.join(asking.select("query", "query_id"), "query").select("query_id", "rank", F.col("id").alias(id_col), "score")
