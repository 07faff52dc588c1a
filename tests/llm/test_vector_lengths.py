"""Vectors of several lengths, and the forest's recall in a large dense cluster."""

from __future__ import annotations

import numpy as np
import pytest

from geoledger.llm import embeddings


def test_each_length_links_among_itself(spark):
    rng, rows = np.random.default_rng(4), []
    for dim, n in ((8, 6), (12, 4), (5, 3)):
        base = rng.standard_normal(dim)
        rows += [(len(rows) + k, (base + 0.01 * rng.standard_normal(dim)).tolist()) for k in range(n)]
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [found[k]["n_links"] for k in range(13)] == [5] * 6 + [3] * 4 + [2] * 3
    assert [found[k]["component_id"] for k in range(13)] == [0] * 6 + [6] * 4 + [10] * 3


def test_very_small_and_very_large_vectors(spark):
    ones = [1.0] * 8
    rows = [(k, [f * x for x in ones]) for k, f in enumerate((1e-200, 2e-200, 1e200, 1.7e308, 5e-324, 1.0))] + [(9, [-1.0] * 8), (10, [float("inf")] * 8)]
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(found[k]["n_links"] == 5 and found[k]["component_id"] == 0 for k in range(6))
    assert all(found[k]["n_links"] == 0 and found[k]["kept"] for k in (9, 10))


def test_bound_is_taken_in_double_precision(spark):
    # Cosines within 1e-9 of the bound, on either side of it.
    angle = np.arccos(0.95)
    rows = [(0, [1.0, 0.0, 0.0]), (1, [float(np.cos(angle - 1e-9)), float(np.sin(angle - 1e-9)), 0.0]), (2, [float(np.cos(angle + 1e-9)), 0.0, float(np.sin(angle + 1e-9))])]
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {0: 1, 1: 1, 2: 0}


def test_small_tables_are_split_too(spark):
    assert [embeddings.depth_for(n) for n in (1, 500, 8000, 8001, 1 << 20)] == [3, 3, 3, 4, 11]
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 64))
    x = np.concatenate((x, x[:150] + 0.25 * rng.standard_normal((150, 64)), x[1] + 0.2 * rng.standard_normal((50, 64))))
    few = rng.standard_normal((3, 2))
    rows = [(i, v.tolist()) for i, v in enumerate([*x, *few])]
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want, got = (unit @ unit.T >= 0.95).sum(1) - 1, np.array([found[i] for i in range(len(x))])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum() and want.sum() > 1000
    # The leaves of the splits are smaller than the table.
    forest = embeddings.Forest(unit, embeddings.depth_for(len(x)), embeddings.TREES)
    assert max(np.bincount(np.concatenate(forest.cells(unit)))) < len(x) / 2


@pytest.mark.parametrize("kind", ["float", "double"])
def test_forest_of_several_levels_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(embeddings, "LEAF", 40)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((500, 16))
    x = np.concatenate((x, x[:300] + 0.22 * rng.standard_normal((300, 16)), x[0] + 0.2 * rng.standard_normal((120, 16)))).astype(np.float32).astype(float)
    rows = [(i, [float(a) for a in v], 1, "clash") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, k int, cells string").repartition(5)
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want, got = near.sum(1) - 1, np.array([found[i]["n_links"] for i in range(len(x))])
    assert embeddings.depth_for(len(x)) >= 4
    assert (got <= want).all() and got.sum() >= 0.98 * want.sum() and want.sum() > 1000


def recall(n: int, trees: int | None = None, dim: int = 64) -> float:
    """Of random pairs of a cluster with cosine 0.95 to 0.96, the share that some leaf holds."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal(dim) / dim**0.5 + rng.standard_normal((n, dim)) * (0.051 / dim) ** 0.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    depth = embeddings.depth_for(n)
    forest = embeddings.Forest(x[: embeddings.SAMPLE], depth, trees or embeddings.trees_for(depth))
    a, b = rng.integers(0, n, 20_000), rng.integers(0, n, 20_000)
    cosine = (x[a] * x[b]).sum(1)
    near = (cosine >= 0.95) & (cosine < 0.96) & (a != b)
    one, two = forest.cells(x[a[near][:2000]]), forest.cells(x[b[near][:2000]])
    return float(np.mean([bool(set(p) & set(q)) for p, q in zip(one, two, strict=True)]))


def test_recall_in_a_large_dense_cluster():
    assert recall(200_000) >= 0.99
