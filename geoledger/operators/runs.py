"""Pairing of scenes, resuming, summaries of runs, and logs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from geoledger.functions.text import log_header, log_time


def setting(layers: list[Column], default: str, low: int, high: int) -> Column:
    """The first layer that is set, as a whole number within bounds; anything else is an error, not clamped."""
    raw = F.coalesce(*layers, F.lit(default))
    number = F.when(raw.rlike("^[0-9]+$"), raw.try_cast("long"))
    wrong = F.raise_error(F.concat(F.lit("setting out of range: "), raw)).cast("long")
    return F.when(number.between(low, high), number).otherwise(wrong)


def with_files(features: DataFrame, pre: str, post: str) -> DataFrame:
    """``features`` with pre_file and post_file filled where absent or null, and zero codes where absent."""
    fill = lambda name, value: F.coalesce(F.col(name), F.lit(value)) if name in features.columns else F.lit(value)
    return features.withColumns({n: fill(n, v) for n, v in (("pre_file", pre), ("post_file", post), ("pre_code", 0), ("curr_code", 0))})


def paired(pre: DataFrame, post: DataFrame) -> DataFrame:
    """Scenes of both dates by stem (stem, pre_path, post_path): of a stem's files .tif is taken before .tiff."""
    one = lambda df, name: df.groupBy("stem").agg(F.min_by("path", F.struct(F.length("path"), "path")).alias(name))
    return one(pre, "pre_path").join(one(post, "post_path"), "stem")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "left_anti")


def with_missing(files: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """``files`` with ``missing``, the names of the parts that aren't there, in order."""
    return files.withColumn("missing", F.array_compact(F.array(*[F.when(~has, F.lit(name)) for name, has in parts.items()])))


def overlap_window(pairs: DataFrame, width: str, height: str) -> DataFrame:
    """Grids a and b (x, y of the corner, res, size) with offsets and size, cut to whole pixels, of their common window; null when apart."""
    low = lambda c: F.greatest(F.col(f"a_{c}"), F.col(f"b_{c}"))
    high = lambda c, n: F.least(F.col(f"a_{c}") + F.col(f"a_{n}") * F.col("res"), F.col(f"b_{c}") + F.col(f"b_{n}") * F.col("res"))
    w, h = ((high("x", width) - low("x")) / F.col("res")).cast("int"), ((high("y", height) - low("y")) / F.col("res")).cast("int")
    some = (w > 0) & (h > 0)
    at = lambda side, c: F.when(some, ((low(c) - F.col(f"{side}_{c}")) / F.col("res")).cast("int"))
    return pairs.withColumns({"a_col": at("a", "x"), "a_row": at("a", "y"), "b_col": at("b", "x"), "b_row": at("b", "y"), "cols": F.when(some, w), "rows": F.when(some, h)})


def cropped(cells: DataFrame, windows: DataFrame, side: str, key: str) -> DataFrame:
    """A side's cells within its window (see :func:`overlap_window`) of the same ``key``, counted from the window's corner."""
    row, col = F.col(f"{side}_row"), F.col(f"{side}_col")
    cut = windows.where(row.isNotNull()).select(key, row, col, "rows", "cols")
    r, c = F.col("r") - row, F.col("c") - col
    inside = (r >= 0) & (r < F.col("rows")) & (c >= 0) & (c < F.col("cols"))
    return cells.join(cut, key).where(inside).withColumns({"r": r, "c": c}).select(*cells.columns)


def alignment(same_origin: Column, same_resolution: Column) -> Column:
    """How a raster is brought onto the other's grid."""
    return F.when(same_resolution & same_origin, "as is").when(same_resolution, "crop").otherwise("resample")


def resumed(tasks: DataFrame, records: DataFrame) -> DataFrame:
    """``tasks`` with the reason why each is taken over or computed anew, by stem, identity and the result's hash."""
    found = tasks.join(records.select("stem", F.col("identity").alias("was"), F.col("digest").alias("had")), "stem", "left")
    reason = (
        F.when(F.col("was").isNull(), "no record")
        .when(~F.col("was").eqNullSafe(F.col("identity")), "identity differs")
        .when(~F.col("had").eqNullSafe(F.col("digest")), "result differs")
        .otherwise("resumed")
    )
    return found.withColumn("reason", reason).drop("was", "had")


def accepted(records: DataFrame, current: str, allowed: DataFrame) -> DataFrame:
    """Records of the current algorithm, or of one that is listed for it."""
    listed = allowed.where(F.col("current") == current).select(F.col("older").alias("algorithm"))
    return records.where(F.col("algorithm") == current).unionByName(records.where(F.col("algorithm") != current).join(listed, "algorithm", "left_semi").select(*records.columns))


def outcome(results: DataFrame) -> DataFrame:
    """One row: counts by outcome and the batch's status; no success is a failure."""
    n = lambda s: F.count_if(F.col("status") == s)
    good = n("new") + n("resumed") + n("empty")
    status = F.when(good == 0, "failed").when(n("failed") > 0, "completed_with_warnings").otherwise("completed")
    return results.agg(good.alias("processed"), n("resumed").alias("resumed"), n("new").alias("fresh"), n("failed").alias("failed"), n("empty").alias("empty"), status.alias("status"))


def log_attempts(lines: DataFrame) -> DataFrame:
    """Lines (file, line_no, value) with the header of the attempt they belong to: the last one before them in their file."""
    header = log_header(F.col("value"))
    upto = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(header["total"] != "", F.struct(F.col("line_no").alias("first_line"), *[c.alias(n) for n, c in header.items()]))
    return lines.withColumns({"time": log_time(F.col("value")), "attempt": F.last(own, ignorenulls=True).over(upto)})


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """The latest attempt of each stem; an unfinished rerun cancels an earlier success."""
    order = Window.partitionBy("stem").orderBy(F.desc("time"), F.asc("file"), F.desc("line_no"))
    return attempts.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def fingerprint(files: DataFrame, keys: list[str]) -> DataFrame:
    """A SHA-256 of each key's sorted files (path, size, mtime); keys of NaN are one, as in a grouping.

    Files are dealt by key and sorted, and hashed as they pass: a task holds one batch, however many files a key has.
    """
    own = F.concat_ws("|", "path", F.col("size").cast("string"), F.col("mtime").cast("string"))
    schema = StructType([*[files.schema[k] for k in keys], StructField("fingerprint", StringType())])
    kinds = to_arrow_schema(schema)

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple = ()
        digest = None
        for part in parts:
            done = []
            for *key, line in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if digest is not None and all(x == y or x != x and y != y for x, y in zip(key, now, strict=True)):
                    digest.update(b"\n" + line.encode())
                    continue
                if digest is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = tuple(key), hashlib.sha256(line.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row, strict=True)) for row in done], schema=kinds)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, (*now, digest.hexdigest()), strict=True))], schema=kinds)

    listed = files.select(*keys, own.alias("_line"))
    return listed.repartition(*keys).sortWithinPartitions(*keys, "_line").mapInArrow(each, schema)


def complete(expected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: whether every expected key is done, and how many aren't."""
    return expected.join(done, key, "left_anti").agg((F.count("*") == 0).alias("complete"), F.count("*").alias("waiting"))


def latest_item(items: DataFrame, keys: list[str], value: str, time: str, default: str) -> DataFrame:
    """The newest item of each key, a default where there is none."""
    return items.groupBy(*keys).agg(F.coalesce(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(time))), F.lit(default)).alias(value))
