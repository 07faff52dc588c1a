"""Stateful processors on streams: stalls, throttles that flush by timers, trackers in event-time order; and a sink that may be away.

They need Spark's RocksDB state store: set ``spark.sql.streaming.stateStore.providerClass`` to :data:`STATE_STORE` on the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from geoledger.operators.scoring import follow
from geoledger.scratch import drop_table, shared_folder
from geoledger.streaming.progress import send

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Watch(StatefulProcessor):
    """The last event of a task and a timer that goes off ``limit`` seconds after it was read."""

    def __init__(self, limit: float, finished: frozenset[str]):
        self.limit, self.finished = limit, finished

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "cur long, status string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = self.last.get() if self.last.exists() else None
        for df in rows:
            for cur, status in zip(df["cur"].tolist(), df["status"].tolist(), strict=True):
                if newest is None or cur >= newest[0]:
                    newest = (cur, status)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if newest[1] in self.finished:
            self.last.clear()
            yield pd.DataFrame([(key[0], newest[0], newest[1], "exit")], columns=_REPORT)
            return
        self.last.update(newest)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.limit * 1000))
        yield pd.DataFrame([], columns=_REPORT)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        cur, status = self.last.get() or (None, None)
        yield pd.DataFrame([(key[0], cur, status, "stall")], columns=_REPORT)

    def close(self) -> None:
        pass


_REPORT = ["task", "cur", "status", "what"]


def watched(events: DataFrame, limit: float, finished: tuple[str, ...] = ("done", "failed")) -> DataFrame:
    """(task, cur, status, what) on a stream of (task, cur, status): ``stall`` once a task is silent for ``limit`` seconds of processing
    time, without a further event; ``exit`` when it ends in a status of ``finished``, after which it is watched no more."""
    key = events.schema["task"].dataType.simpleString()
    schema = f"task {key}, cur long, status string, what string"
    rows = events.select("task", F.col("cur").cast("long").alias("cur"), "status")
    return rows.groupBy("task").transformWithStateInPandas(_Watch(limit, frozenset(finished)), schema, "Append", "processingTime")


class _Throttle(StatefulProcessor):
    """The message sent last, the newest one held back, and a timer for when that is due."""

    def __init__(self, least_step: float, least_seconds: float):
        self.least_step, self.least_seconds = least_step, least_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", "file string, progress double, at double")
        self.held = handle.getValueState("held", "cur long, file string, progress double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs() / 1000
        last, held, out = self.sent.get() if self.sent.exists() else None, None, []
        messages = pd.concat(list(rows)).sort_values("cur", kind="stable")
        for cur, file, progress in messages[["cur", "file", "progress"]].itertuples(index=False, name=None):
            if send(last, file, progress, now, self.least_step, self.least_seconds):
                last, held = (file, float(progress), now), None
                out.append((key[0], cur))
            elif not (last[0] == file and last[1] >= 100 and progress >= 100):
                held = (cur, file, float(progress))
        self.sent.update(last)
        if held is not None or out:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.held.clear()
        if held is not None:
            self.held.update(held)
            self.handle.registerTimer(int((last[2] + self.least_seconds) * 1000) + 1)
        yield pd.DataFrame(out, columns=["task", "cur"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        cur, file, progress = self.held.get()
        self.held.clear()
        self.sent.update((file, progress, timerValues.getCurrentProcessingTimeInMs() / 1000))
        yield pd.DataFrame([(key[0], cur)], columns=["task", "cur"])

    def close(self) -> None:
        pass


def flushed(events: DataFrame, least_step: float, least_seconds: float) -> DataFrame:
    """(task, cur) of the messages that a throttled sender gives out on a stream of (task, cur, file, progress).

    As the throttle on batches, by the time at which messages are read. The newest message that was held back goes out once
    ``least_seconds`` are over, without a further event.
    """
    key = events.schema["task"].dataType.simpleString()
    rows = events.select("task", F.col("cur").cast("long").alias("cur"), "file", F.col("progress").cast("double").alias("progress"))
    return rows.groupBy("task").transformWithStateInPandas(_Throttle(least_step, least_seconds), f"task {key}, cur long", "Append", "processingTime")


_BOX = ["x0", "y0", "x1", "y1"]


class _Follow(StatefulProcessor):
    """A video's live tracks, and the frames that the watermark hasn't passed yet."""

    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getListState("live", "track long, x0 double, y0 double, x1 double, y1 double, period long, lost long")
        self.waiting = handle.getListState("waiting", "at long, frame long, id long, x0 double, y0 double, x1 double, y1 double")
        self.place = handle.getValueState("place", "fresh long, done long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        done = self.place.get()[1] if self.place.exists() else -(1 << 62)
        new = []
        for df in rows:
            at = df["at"].tolist()
            new += [r for r in zip(at, *[df[c].tolist() for c in ("frame", "id", *_BOX)], strict=True) if r[0] > done]
        if new:
            self.waiting.appendList(new)
            for at in {r[0] for r in new}:
                self.handle.registerTimer(max(at, timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame([], columns=self.columns)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        now = [r for r in waiting if r[0] <= passed]
        out: list[tuple] = []
        if now:
            fresh, _ = self.place.get() if self.place.exists() else (0, 0)
            live = [[t, np.array(b), period, lost] for t, *b, period, lost in (self.live.get() if self.live.exists() else [])]
            frames: dict[tuple, list] = {}
            for r in now:
                frames.setdefault(r[:2], []).append(r[2:])
            for (_, frame), boxes in sorted(frames.items()):
                tracks, live, fresh = follow(live, fresh, np.array([b[1:] for b in boxes], float), **self.options)
                out += [(key[0], frame, b[0], t) for b, t in zip(boxes, tracks, strict=True)]
            self.place.update((fresh, now[-1][0]))
            keep = [r for r in waiting if r[0] > passed]
            self.waiting.put(keep) if keep else self.waiting.clear()
            rows = [(t, *map(float, b), period, lost) for t, b, period, lost in live]
            self.live.put(rows) if rows else self.live.clear()
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def tracked_stream(boxes: DataFrame, video: str, frame: str, id_: str, ts: str, lateness: str, least: float = 0.5, lost_frames: int = 2, least_period: int = 1, method: str = "iou") -> DataFrame:
    """(video, frame, id, track) on a stream of boxes, as :func:`geoledger.operators.scoring.tracked` gives on a batch.

    ``ts`` is a frame's time. Frames wait until the watermark, ``lateness`` behind the latest, has passed them and are followed in the
    order of their times; boxes of a frame that comes later are dropped. State: the live tracks and waiting frames of each video.
    """
    key = boxes.schema[video].dataType.simpleString()
    options = {"least": least, "lost_frames": lost_frames, "least_period": least_period, "method": method}
    timed = boxes.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    rows = timed.select(F.col(video), "_ts", F.unix_millis("_ts").alias("at"), F.col(frame).cast("long").alias("frame"), F.col(id_).cast("long").alias("id"), *_BOX)
    columns = [video, frame, id_, "track"]
    schema = f"{video} {key}, {frame} long, {id_} long, track long"
    return rows.groupBy(video).transformWithStateInPandas(_Follow(options, columns), schema, "Append", "eventTime")


class PendingSink:
    """Messages for a sink that may be away: of each task the newest one is kept, in a table, until the sink takes it.

    ``send`` gets a DataFrame (task, cur, status), the newest message first, and raises if the sink is away. Use ``sink`` as
    the function of ``foreachBatch``: kept messages are sent with those of the next batch, or by ``flush``. A message is sent at
    least once: after a failure between sending and writing down that it was sent, it is sent again.
    """

    def __init__(self, spark: SparkSession, send: Callable[[DataFrame], None], name: str = "pending"):
        self.spark, self.send, self.folder, self.kept, self.n = spark, send, f"{shared_folder(spark)}/{name}", None, 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = batch.select("task", "cur", "status")
        self._offer(new if self.kept is None else new.unionByName(self.spark.read.parquet(self.kept)))

    def flush(self) -> bool:
        """Send what is kept; whether nothing is kept after it."""
        if self.kept is not None:
            self._offer(self.spark.read.parquet(self.kept))
        return self.kept is None

    def _offer(self, messages: DataFrame) -> None:
        newest = messages.groupBy("task").agg(F.max("cur").alias("cur"), F.max_by("status", "cur").alias("status"))
        self.n += 1
        path, old = f"{self.folder}-{self.n}", self.kept
        newest.write.mode("overwrite").parquet(path)
        self.kept = path
        if old is not None:
            drop_table(self.spark, old)
        try:
            self.send(self.spark.read.parquet(path).orderBy(F.desc("cur"), "task"))
        except Exception:  # noqa: BLE001 - whatever the sink raises, its messages stay
            return
        self.kept = None
        drop_table(self.spark, path)
