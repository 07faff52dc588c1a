"""Timers, trackers and a sink that comes back, on streams."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from geoledger.operators import scoring
from geoledger.plans.views import view
from geoledger.streaming import watch


@pytest.fixture(autouse=True)
def state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, watch.STATE_STORE)
    yield
    spark.conf.unset(key)


def started(df, name, tmp_path, **trigger):
    out = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "state"))
    return out.trigger(**(trigger or {"processingTime": "300 milliseconds"})).start()


def until(spark, name, rows, seconds=60):
    end = time.time() + seconds
    while time.time() < end and spark.table(name).count() < rows:
        time.sleep(0.3)
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def test_a_stall_is_reported_without_a_further_event(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "task long, cur long, status string"
    spark.createDataFrame([(1, 1, "on"), (1, 2, "on"), (2, 1, "on"), (2, 2, "done"), (3, 5, "on")], schema).coalesce(1).write.parquet(folder)
    query = started(watch.watched(spark.readStream.schema(schema).parquet(folder), limit=2.0), "stalls", tmp_path)
    try:
        assert until(spark, "stalls", 3) == [(1, 2, "on", "stall"), (2, 2, "done", "exit"), (3, 5, "on", "stall")]
        # A task that goes on is watched again.
        spark.createDataFrame([(1, 3, "failed"), (3, 6, "on")], schema).coalesce(1).write.mode("append").parquet(folder)
        assert until(spark, "stalls", 5)[1:] == [(1, 3, "failed", "exit"), (2, 2, "done", "exit"), (3, 5, "on", "stall"), (3, 6, "on", "stall")]
    finally:
        query.stop()


def test_a_message_held_back_goes_out_in_time(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "task long, cur long, file string, progress double"
    spark.createDataFrame([(1, 1, "a", 0.0), (1, 2, "a", 1.0), (1, 3, "a", 1.5), (2, 1, "b", 50.0), (2, 2, "b", 100.0), (2, 3, "b", 100.0)], schema).coalesce(1).write.parquet(folder)
    query = started(watch.flushed(spark.readStream.schema(schema).parquet(folder), least_step=5.0, least_seconds=2.0), "flushed", tmp_path)
    try:
        # 2 is passed over, 3 is the newest that was held back; an end is said once.
        assert until(spark, "flushed", 4) == [(1, 1), (1, 3), (2, 1), (2, 2)]
    finally:
        query.stop()


@pytest.mark.parametrize("method", ["iou", "assignment"])
def test_tracks_of_a_stream_are_those_of_the_batch(spark, sf_dir, tmp_path, method):
    boxes = view(spark, sf_dir, "v_boxes").where("is_gt = 0").withColumn("video", F.floor(F.col("image_id") / 20).cast("long"))
    # A frame a second; boxes are large, so that tracks go on.
    boxes = boxes.withColumns({"x1": F.col("x0") + 120, "y1": F.col("y0") + 120, "ts": F.timestamp_seconds(F.col("image_id") + 10**9)}).select("video", "image_id", "box_id", "x0", "y0", "x1", "y1", "ts")
    batch = scoring.tracked(boxes, "video", "image_id", "box_id", least=0.3, method=method)
    last, folder = boxes.agg(F.max("image_id")).first()[0], str(tmp_path / "in")
    # Within a file frames come in any order; files overlap by less than the lateness.
    for k, (a, b) in enumerate(((-1, 60), (60, 300), (300, last))):
        boxes.where(f"image_id > {a} and image_id <= {b}").orderBy(F.xxhash64("box_id")).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    end = spark.createDataFrame([(-1, 10**6, 1, 0.0, 0.0, 1.0, 1.0, dt.datetime(2200, 1, 1))], boxes.schema)
    end.coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)
    # Long after its time: dropped.
    end.withColumns({"video": F.lit(0).cast("long"), "image_id": F.lit(3).cast("long"), "ts": F.timestamp_seconds(F.lit(10**9 + 3))}).coalesce(1).write.mode("append").parquet(folder)
    live = spark.readStream.schema(boxes.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = watch.tracked_stream(live, "video", "image_id", "box_id", "ts", "10 seconds", least=0.3, method=method)
    started(out, f"tracks_{method}", tmp_path, availableNow=True).awaitTermination(180)
    found = spark.table(f"tracks_{method}").where("video >= 0")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))
    assert batch.groupBy("video", "track").count().where("count > 1").count() > 5


def test_a_sink_that_comes_back_gets_the_newest_messages(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "task long, cur long, status string"
    taken, calls = [], []

    def send(messages):
        calls.append(1)
        if len(calls) <= 2:
            raise ConnectionError("away")
        taken.append([tuple(r) for r in messages.collect()])

    sink = watch.PendingSink(spark, send, name=f"pending-{time.time_ns()}")
    for rows in ([(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 3, "d")], [(3, 9, "e")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    live.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
    assert taken == [[(3, 9, "e"), (1, 3, "d"), (2, 1, "b")]] and sink.flush() and len(calls) == 3
