"""Connected components of an edge table, by alternating star contractions.

Every round is a fixed number of shuffles over the edges; a vertex's neighbours are never gathered, only their
minimum is taken (with map-side combine), so that a vertex with a third of all edges is no problem. The number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.scratch import drop_written, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node that can be reached.

    Nulls and loops in ``edges`` say nothing and are left out; repeated edges count once. Nodes without an edge to
    another node aren't in the result. No edges give an empty result.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where(x.isNotNull() & y.isNotNull() & (x != y)).distinct(), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        # Large star: neighbours above a vertex are tied to the least vertex of its neighbourhood.
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: a vertex and those below it are tied to the least of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, state = state, _state(new)
        drop_written(now)
        now = new
        if was == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
