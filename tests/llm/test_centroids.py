"""Clustering and exact search against brute force."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoledger.llm import centroids, topk


def kept(rows, dim):
    return [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]


def plain_clusters(rows, dim=64, k=40, rounds=5):
    data = kept(rows, dim)
    start = sorted(((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest()), v) for i, v in data)[:k]
    cs = [list(v) for _, v in start]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in data]
        for j in set(own):
            mine = [v for (_, v), o in zip(data, own, strict=True) if o == j]
            cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    ends = [near(v) for _, v in data]
    by = {j: sum(d for d, o in ends if o == j) for j in {o for _, o in ends}}
    most = (1 << 63) - 1
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((repr(i), j, min(d, most), min(by[j], most), min(sum(by.values()), most), hashes[j]) for (i, _), (d, j) in zip(data, ends, strict=True))


def vectors(dim, n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, dim)) * 0.2 + rng.standard_normal((6, dim))[rng.integers(0, 6, n)] * 0.3, 3)
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    bad = [(900, None), (901, []), (902, [1.0] * (dim - 1)), (903, [float("nan")] * dim), (904, [float("inf"), *[0.0] * (dim - 1)]), (905, [None, *[0.0] * (dim - 1)])]
    return [*rows, *bad, *rows[:5], (None, rows[0][1]), (0, rows[1][1]), (906, [0.0] * dim), (907, [0.0] * dim)]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 3, "clash") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, v string").repartition(3)


@pytest.mark.parametrize("dim, n, k", [(64, 150, 40), (8, 60, 7), (2, 20, 3), (1, 20, 3), (4, 2, 40)])
def test_clusters(spark, dim, n, k):
    rows = vectors(dim, n)
    found = centroids.cluster(frame(spark, rows), dim=dim, k=k).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in found) == plain_clusters(rows, dim, k)


def test_clusters_of_huge_components(spark):
    rows = [(i, [float(f), 1.0, -2.5 * f, 0.0]) for i, f in enumerate((1e300, -1e300, 3e18, 2.5, 1e12, 7e305, -7e305, 1e12 + 1))]
    found = centroids.cluster(frame(spark, rows), dim=4, k=3).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in found) == plain_clusters(rows, 4, 3)


def test_clusters_of_nothing(spark):
    out = centroids.cluster(frame(spark, [(1, None), (2, [1.0])]))
    assert out.isEmpty() and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_transform_keeps_distances():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-500, 500, (300, 64)), rng.integers(-500, 500, (40, 64))
    c[7] = c[3]  # a tie
    t = centroids.walsh_hadamard(x)
    assert (centroids.inverse(t) == x).all()
    changes = [int((np.diff(np.sign(h)) != 0).sum()) for h in centroids.inverse(np.eye(64, dtype=np.int64) * 64)]
    assert changes == list(range(64))
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    best, total = centroids.nearest(t, centroids.walsh_hadamard(c))
    assert (best == full.argmin(1)).all() and (total == 64 * full.min(1)).all()


def plain_top(rows, divisor, k):
    data = [(i, v) for i, v in enumerate(rows) if v[1] is not None and all(x is not None and math.isfinite(x) for x in v[1])]
    whole = [(u, i, kept([(i, v)], len(v))[0][1]) for u, (i, v) in data]
    out = []
    for u, i, q in whole:
        if i is not None and i % divisor == 0:
            scores = [(-max(min(sum(a * b for a, b in zip(q, v, strict=True)), (1 << 63) - 1), -(1 << 63)), j is None, j or 0) for w, j, v in whole if w != u and len(v) == len(q)]
            out += [(i, n + 1, repr(None if none else j), -s) for n, (s, none, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_top_k(spark, monkeypatch, small, kind):
    if small:  # many shards and nodes, several blocks, steps and groups of roots
        for name, value in (("SHARD", 24), ("LEAF", 3), ("QUERIES", 5), ("STEP", 2), ("PASSES", (1, 2, None)), ("ROOTS", 2)):
            monkeypatch.setattr(topk, name, value)
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors(8, 160)]
    rows += [(1000 + i, rows[20][1]) for i in range(40)] + [(2000 + i, [1.0, 2.0]) for i in range(3)] + [(2010, []), (2020, [])]
    found = topk.search(frame(spark, rows, kind), F.col("vec_id") % 10 == 0, k=5).collect()
    assert sorted((r["query_id"], r["rank"], repr(r["vec_id"]), r["score"]) for r in found) == plain_top(rows, 10, 5)


def test_top_k_of_huge_components(spark):
    rows = [(i, [f, -f]) for i, f in enumerate((1e300, -1e300, 1e9, 3e9, 1e-9, 0.0, 7e305))]
    found = topk.search(frame(spark, rows), F.col("vec_id") >= 0, k=3).collect()
    assert sorted((r["query_id"], r["rank"], repr(r["vec_id"]), r["score"]) for r in found) == plain_top(rows, 1, 3)


def test_top_k_of_nothing(spark):
    for rows in ([], [(10, None)], [(10, [1.0])], [(11, [1.0]), (12, [2.0])]):
        out = topk.search(frame(spark, rows), F.col("vec_id") % 10 == 0)
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.isEmpty()


def test_bounds_pass_over_most_of_a_clustered_shard():
    rng = np.random.default_rng(5)
    x = np.rint((rng.standard_normal((64, 16))[rng.integers(0, 64, 8000)] + 0.03 * rng.standard_normal((8000, 16))) * 256).astype(np.int64)
    tree, best, kth = topk.BallTree(x, 64), topk._Best(50, 5), np.full(50, -np.inf)
    y, q = x[tree.order], x[:50]

    def score(asking, leaf):
        lo, hi = tree.spans[leaf]
        best.add(asking, topk.products(q[asking], y[lo:hi]), np.broadcast_to(np.arange(lo, hi), (len(asking), hi - lo)), np.arange(len(y)))
        kth[asking] = np.where(best.id[asking, -1] < 0, -np.inf, best.score[asking, -1])

    compared = tree.search(q, kth, 5, score)
    assert (best.score == -np.sort(-(q @ x.T), 1)[:, :5]).all() and compared < 0.35 * 50 * 8000
