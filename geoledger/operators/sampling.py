"""Deterministic samples: hashes give each row a place that doesn't depend on partitions or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.functions.text import hash_rank


def place(key: Column, seed: str = "") -> Column:
    """A key's place in a random but fixed order."""
    return hash_rank(F.concat(key.cast("string"), F.lit("|" + seed)))


def uniform(key: Column, seed: str = "") -> Column:
    """From 0, included, to 1."""
    return place(key, seed) / F.lit(float(1 << 60))


def stratified(rows: DataFrame, source: str, stratum: str, key: str, count: int) -> DataFrame:
    """``count`` rows: the strata of a source take turns, then the sources; within a stratum the hash decides.

    Each source and stratum keeps at most ``count`` rows before the global order, so that it sorts few.
    """
    own = Window.partitionBy(source, stratum).orderBy(place(F.col(key)), key)
    best = rows.withColumn("_k", F.row_number().over(own)).where(F.col("_k") <= count)
    turns = Window.partitionBy(source).orderBy("_k", stratum)
    turned = best.withColumn("_turn", F.row_number().over(turns)).where(F.col("_turn") <= count)
    return turned.orderBy("_turn", source).limit(count).drop("_k", "_turn")


def subset(rows: DataFrame, key: str, ratio: float, seed: str = "") -> DataFrame:
    """Rows whose place is within the ratio; about that share, always the same rows."""
    return rows.where(uniform(F.col(key), seed) < ratio)


def with_repeats(rows: DataFrame, key: str, factor: Column, seed: str = "") -> DataFrame:
    """Each row as often as its factor's whole part, and once more with the probability of the rest."""
    n = F.floor(factor) + (uniform(F.col(key), seed) < factor - F.floor(factor)).cast("int")
    return rows.withColumn("_n", n.cast("int")).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")


def balanced(rows: DataFrame, group: str, key: str, label: str, total: int, positive_share: float, background: int, ignore: int = -1) -> DataFrame:
    """Of each group up to int(total * share) positives, and negatives for the rest."""
    positive = (F.col(label) != background).alias("positive")
    some = rows.where(F.col(label) != ignore).withColumn("positive", positive)
    own = Window.partitionBy(group, "positive").orderBy(place(F.col(key)), key)
    most = int(total * positive_share)
    ranked = some.withColumn("_k", F.row_number().over(own))
    taken = F.least(F.max(F.when(F.col("positive"), F.col("_k"))).over(Window.partitionBy(group)), F.lit(most))
    ranked = ranked.withColumn("_taken", F.coalesce(taken, F.lit(0)))
    return ranked.where((F.col("positive") & (F.col("_k") <= most)) | (~F.col("positive") & (F.col("_k") <= total - F.col("_taken")))).drop("_k", "_taken")


def per_group(rows: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group in an order."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def confident(rows: DataFrame, group: str, key: str, score: str, k: int, multiple: int) -> DataFrame:
    """k rows by hash of the k * multiple with the highest scores."""
    best = per_group(rows, group, [F.desc(score), F.asc(key)], k * multiple)
    return per_group(best, group, [place(F.col(key)), F.asc(key)], k)


def shards(rows: DataFrame, group: str, order: str, parts: int) -> DataFrame:
    """``rows`` with ``shard``: contiguous parts of each group, the first n % parts with one row more."""
    n = F.count("*").over(Window.partitionBy(group))
    at = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    out = rows.withColumns({"_n": n, "_at": at})
    size, more = F.floor(F.col("_n") / parts), F.col("_n") % parts
    long_part = more * (size + 1)
    shard = F.when(F.col("_at") < long_part, F.floor(F.col("_at") / (size + 1))).otherwise(more + F.floor((F.col("_at") - long_part) / F.greatest(size, F.lit(1))))
    return out.withColumn("shard", shard.cast("long")).drop("_n", "_at")


def batches(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """``rows`` with ``batch`` within their group; an incomplete last batch isn't given out."""
    at = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    out = rows.withColumn("batch", F.floor(at / size).cast("long"))
    return out.withColumn("_n", F.count("*").over(Window.partitionBy(group, "batch"))).where(F.col("_n") == size).drop("_n")


def points_in_boxes(boxes: DataFrame, key: str, k: int) -> DataFrame:
    """k whole points in each box (x0, y0, x1, y1), by hash."""
    each = boxes.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    spot = lambda a, b, s: F.floor(F.col(a) + uniform(F.concat_ws("|", F.col(key).cast("string"), F.col("i").cast("string")), s) * (F.col(b) - F.col(a)))
    return each.withColumns({"px": spot("x0", "x1", "x"), "py": spot("y0", "y1", "y")})
