"""Progress events: the same functions on a batch and, where Spark allows it, on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def stream(spark: SparkSession, path: str, schema: str = EVENTS) -> DataFrame:
    """Events as a stream of the Parquet files that arrive under ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def latest(events: DataFrame) -> DataFrame:
    """(task, progress): share done by the latest event, 1 once there is a result; events have task, cur, current, total, status."""
    done = F.max_by("status", "cur") == "purchase"
    part = F.least(F.lit(1.0), F.max(F.col("current") / F.col("total")))
    return events.groupBy("task").agg(F.when(done, F.lit(1.0)).otherwise(part).alias("progress"))


def overall(tasks: DataFrame) -> DataFrame:
    """One row: the tasks' progress together, from 5 to 95."""
    return tasks.agg((5 + 90 * F.sum("progress") / F.count("*")).alias("overall"))


def stalls(events: DataFrame, limit: float) -> DataFrame:
    """Events after which a task was silent for longer than ``limit`` seconds."""
    then = F.lead("ts").over(Window.partitionBy("task").orderBy("cur"))
    gap = (F.unix_micros(then) - F.unix_micros("ts")) / 1e6
    return events.withColumn("gap", gap).where(F.col("gap") > limit)


def pending(events: DataFrame) -> DataFrame:
    """The newest message of each task: all that is kept while the sink is away."""
    return events.groupBy("task").agg(F.max_by("status", "cur").alias("status"), F.max("cur").alias("cur"))


def send(last: tuple | None, file: str, progress: float, seconds: float, least_step: float, least_seconds: float) -> bool:
    """Whether a message goes out: the first, another file, far enough, late enough, or the end; never the same end twice."""
    if last is None:
        return True
    if last[0] == file and last[1] >= 100 and progress >= 100:
        return False
    return last[0] != file or progress - last[1] >= least_step or seconds - last[2] >= least_seconds or progress >= 100


def throttled(events: DataFrame, least_step: float, least_seconds: float) -> DataFrame:
    """(task, cur) of the events that a throttled sender gives out; events have task, cur, ts, file, progress.

    Events are dealt by task and sorted; a task of Spark reads them one after the other and keeps the last one sent only.
    """

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, last = None, None
        for df in parts:
            kept = []
            seconds = df["ts"].astype("int64") / 1e9 if str(df["ts"].dtype).startswith("datetime64[ns") else df["ts"].map(lambda t: t.timestamp())
            for now, cur, file, progress, at in zip(df["task"], df["cur"], df["file"], df["progress"], seconds, strict=True):
                if now != task:
                    task, last = now, None
                if send(last, file, progress, at, least_step, least_seconds):
                    last = (file, progress, at)
                    kept.append((task, cur))
            yield pd.DataFrame(kept, columns=["task", "cur"])

    ordered = events.select("task", "cur", "ts", "file", "progress").repartition("task").sortWithinPartitions("task", "cur")
    return ordered.mapInPandas(each, "task long, cur long")


def throttled_stream(events: DataFrame, least_step: float, least_seconds: float) -> DataFrame:
    """The same on a stream, with the last message sent of each task as its state; events must come in order within a task."""

    def each(key: Any, parts: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        kept = []
        for df in parts:
            for cur, file, progress, ts in df.sort_values("cur")[["cur", "file", "progress", "ts"]].itertuples(index=False):
                at = ts.timestamp()
                if send(last, file, progress, at, least_step, least_seconds):
                    last = (file, float(progress), at)
                    kept.append((key[0], cur))
        if last is not None:
            state.update(last)
        yield pd.DataFrame(kept, columns=["task", "cur"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return events.groupBy("task").applyInPandasWithState(each, "task long, cur long", "file string, progress double, at double", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, width: str, lateness: str) -> DataFrame:
    """Events by type and window, with late ones dropped after ``lateness``."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")
