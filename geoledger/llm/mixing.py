"""Mixing sources to target weights by entropy balancing.

Each source gets a share of all words by its weight; a share above ``most`` times the source's size is cut there, and what
is over goes to the others by weight. Among all rates between 0 and ``most`` copies a document that give each source its
target, those are taken that are nearest to one copy in relative entropy. They are ``min(most, exp(x * size))`` with one
number x per source, found by Newton steps on the convex dual. A step is one aggregation over the counts of documents by
source and size, for all sources at once; bisection stands in where a step leaves the known bounds.

Rates are rounded to copies within shards of a source, from the largest document to the smallest, each so that the words
taken so far stay nearest to the words due. Equal rows are one class there, whatever their number, so that no shard is large.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.llm.words import WORD
from geoledger.scratch import drop_written, written

#: Documents and words that a shard of a source has at most, about.
SHARD_DOCS, SHARD_WORDS = 5000, 3_000_000
_STEPS, _CLOSE, _FAR = 60, 1e-7, 1e5


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0, in code point order of ``source``, null last; never sorted in one task."""
    parts = written(sources.orderBy(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()), "sources")
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    return parts.withColumn("within", within).join(before, "part").withColumn("place", F.col("before") + F.col("within") - 1).drop("part", "within", "before")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources`` (source, source_size, ...) with ``target``: the weights repeat over the sources in code point order."""
    weighed = _ranked(sources).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    weighed = written(weighed.drop("place"), "weights")
    top = F.col("source_size") * float(most)
    row = weighed.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    whole = (row["all"] or 0) * share
    level, capped = (whole / row["w"] if row["w"] else 0.0), 0
    while row["w"]:
        over = F.col("weight") * level > top
        now = weighed.agg(F.count_if(over).alias("n"), F.sum(F.when(over, top)).alias("cut"), F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        if now["n"] == capped or not now["w"]:
            break
        level, capped = (whole - (now["cut"] or 0)) / now["w"], now["n"]
    return weighed.withColumn("target", F.least(F.col("weight") * level, top)).drop("weight")


def _tilts(counts: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """``sources`` with ``tilt``: x times the source's mean size; null where every document has ``most`` copies or none has words."""
    free = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * most * (1 - 1e-9))
    state = sources.withColumns({"tilt": F.when(free, F.lit(0.0)), "low": F.lit(-_FAR), "high": F.lit(_FAR), "gap": F.when(free, F.lit(1.0)).otherwise(0.0)})
    state = written(state, "tilts")
    for _ in range(_STEPS):
        exponent = F.col("tilt") * F.col("size") / F.col("mean_size")
        rate = F.exp(F.least(exponent, F.lit(math.log(most))))
        words = F.col("n") * F.col("size") * rate
        slope = F.when(exponent < math.log(most), words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        sums = counts.join(state.where("tilt is not null"), "source_id").groupBy("source_id").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        new = state.join(sums, "source_id", "left")
        excess = F.col("words") - F.col("target")
        new = new.withColumns({"low": F.when(excess < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(excess > 0, F.col("tilt")).otherwise(F.col("high")), "gap": F.coalesce(F.abs(excess) / F.col("target"), F.lit(0.0))})
        step = F.col("tilt") - excess / F.col("slope")
        inside = F.coalesce((step > F.col("low")) & (step < F.col("high")) & (F.col("slope") > 0), F.lit(False))
        half = F.when(F.col("low") == -_FAR, F.col("tilt") * 4 - 1).when(F.col("high") == _FAR, F.col("tilt") * 4 + 1).otherwise((F.col("low") + F.col("high")) / 2)
        moved = F.when(F.col("tilt").isNull() | (F.col("gap") <= _CLOSE), F.col("tilt")).when(inside, step).otherwise(half)
        new = written(new.withColumn("tilt", moved).drop("words", "slope"), "tilts")
        drop_written(state)
        state = new
        if (state.agg(F.max("gap")).first()[0] or 0) <= _CLOSE:
            break
    else:
        raise RuntimeError(f"rates did not come near their targets in {_STEPS} steps")
    return state.drop("low", "high", "gap")


def _rounded(size: np.ndarray, rate: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many of a class's ``rows`` have their rate rounded up, classes in order: as many as keep the words taken nearest to those due."""
    out, due = [], 0.0
    for s, r, m in zip(size.tolist(), rate.tolist(), rows.tolist(), strict=True):
        part = r - math.floor(r + 1e-9)
        due += s * m * part
        # Of two as near the smaller number.
        up = min(m, max(0, math.ceil(due / s - 0.5))) if part > 1e-9 and s else 0
        due -= s * up
        out.append(up)
    return np.array(out, np.int64)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Columns ``keep`` (all) of every row of ``docs``, with size, source_size, target, rate and copies (0 to ``most``).

    Null texts have size 0, and rows of size 0 get one copy. Null is a source of its own, the last. Repeated rows (of equal
    id, source and text) may be rounded differently, any of them. Columns that are named as the new ones are replaced. An
    empty table gives an empty result. Reruns give the same copies.
    """
    new = ("size", "source_size", "target", "rate", "copies")
    keep = [c for c in (keep or docs.columns) if c not in new]
    named = docs.withColumn("size", words_in(F.col(text_col)))
    sized = written(named.select(F.col(source_col).cast("string").alias("source"), "size"), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("docs"))
    sources = targets(sources, weights, share, most)
    sources = written(sources.withColumn("source_id", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())), "targets")
    key = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    counts = written(sized.where("size > 0").groupBy(key.alias("source_id"), "size").agg(F.count("*").alias("n")), "counts")
    sources = sources.withColumn("mean_size", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)))
    solved = _tilts(counts, sources, most)

    shards = F.ceil(F.greatest(F.col("docs") / SHARD_DOCS, F.col("source_size") / SHARD_WORDS, F.lit(1))).cast("long")
    solved = solved.select("source_id", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "tilt", "mean_size", shards.alias("_shards"))
    source = F.col(source_col).cast("string")
    same = F.xxhash64(F.col(id_col).cast("string"), F.col(id_col).isNull(), F.col(text_col))
    rows = named.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], "size", F.xxhash64(F.coalesce(source, F.lit("")), source.isNull()).alias("source_id"), same.alias("_same"))
    rows = rows.withColumnRenamed("size", "_size")
    full = F.when(F.col("_target") > 0, F.lit(float(most))).otherwise(1.0)
    exponent = F.least(F.col("tilt") * F.col("_size") / F.col("mean_size"), F.lit(math.log(most)))
    rated = F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(F.coalesce(F.exp(exponent), full))
    classes = rows.groupBy("source_id", "_size", "_same").agg(F.count("*").alias("_rows")).join(solved, "source_id")
    classes = classes.withColumns({"_shard": F.pmod(F.xxhash64("_same", "_size", F.lit(5)), F.col("_shards")), "_rate": rated})

    def each(t: pa.Table) -> pa.Table:
        size, rate, rows, order = (t.column(c).to_numpy() for c in ("_size", "_rate", "_rows", "_same"))
        at = np.lexsort((order, -size))
        up = np.empty(len(size), np.int64)
        up[at] = _rounded(size[at], rate[at], rows[at])
        return t.select(["source_id", "_size", "_same", "_rows", "_rate", "_source_size", "_target"]).append_column("_up", pa.array(up))

    rounded = classes.groupBy("source_id", "_shard").applyInArrow(each, "source_id long, _size long, _same long, _rows long, _rate double, _source_size long, _target double, _up long")
    rounded = written(rounded, "rounded")
    out = rows.join(rounded, ["source_id", "_size", "_same"])
    if not rounded.where("_rows > 1 and _up > 0 and _up < _rows").isEmpty():
        out = _numbered(out)
    else:
        out = out.withColumn("_place", F.lit(0))
    copies = F.floor(F.col("_rate") + 1e-9) + F.when(F.col("_place") < F.col("_up"), 1).otherwise(0)
    new_columns = [F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_rate").alias("rate"), copies.cast("long").alias("copies")]
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *new_columns)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_place``: rows of a class that has some rounded up and some not are numbered from 0, over parts that none has to hold all."""
    some = "_rows > 1 and _up > 0 and _up < _rows"
    parts = written(rows.where(some).withColumn("_part", F.spark_partition_id()), "numbered")
    key = ["source_id", "_size", "_same"]
    sizes = parts.groupBy(*key, "_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_before", before).drop("n")
    within = F.row_number().over(Window.partitionBy(*key, "_part").orderBy(F.lit(1))) - 1
    numbered = parts.withColumn("_within", within).join(sizes, [*key, "_part"]).withColumn("_place", F.col("_before") + F.col("_within"))
    return rows.where(f"not ({some})").withColumn("_place", F.lit(0).cast("long")).unionByName(numbered.select(*rows.columns, "_place"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as it has copies."""
    return mixed.where("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
