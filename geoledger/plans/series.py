"""Queries over scalar histories and progress events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoledger.plans.catalog import query
from geoledger.streaming import progress as live


@query("e4_trailing_median", "v_scalars", sql="select name, iter, round(quantile_cont(value, 0.5) over (partition by name order by iter range between 19 preceding and current row), 6) as smooth from v_scalars")
def trailing_median(scalars: DataFrame) -> DataFrame:
    trailing = Window.partitionBy("name").orderBy("iter").rangeBetween(-19, 0)
    return scalars.select("name", "iter", F.round(F.percentile("value", F.lit(0.5)).over(trailing), 6).alias("smooth"))


@query("e5_latest_scalars", "v_scalars", sql="select name, max(iter) as iter, arg_max(value, iter) as value from v_scalars group by name")
def latest_scalars(scalars: DataFrame) -> DataFrame:
    return scalars.groupBy("name").agg(F.max("iter").alias("iter"), F.max_by("value", "iter").alias("value"))


@query("e12_eta", "v_progress", sql="select task, cur, round(quantile_cont(value, 0.5) over (partition by task order by cur rows between 999 preceding and current row) * (total - cur), 4) as eta from v_progress")
def eta(progress: DataFrame) -> DataFrame:
    upto = Window.partitionBy("task").orderBy("cur").rowsBetween(-999, 0)
    return progress.select("task", "cur", F.round(F.percentile("value", F.lit(0.5)).over(upto) * (F.col("total") - F.col("cur")), 4).alias("eta"))


@query("b10_metric_lines", "v_scalars", sql="select iter, count(*) as metrics, round(sum(value), 4) as total from v_scalars group by iter")
def metric_lines(scalars: DataFrame) -> DataFrame:
    lines = scalars.groupBy("iter").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("values"))
    total = F.aggregate(F.map_values("values"), F.lit(0.0), lambda s, v: s + v)
    return lines.select("iter", F.size("values").cast("long").alias("metrics"), F.round(total, 4).alias("total"))


@query("k2_task_progress", "v_progress", sql="select task, round(case when arg_max(status, cur) = 'purchase' then 1.0e0 else least(1, max(cur * 0.9e0 / total)) end, 6) as progress from v_progress group by task")
def task_progress(progress: DataFrame) -> DataFrame:
    reported = progress.withColumn("current", F.col("cur") * 0.9)
    return live.latest(reported).select("task", F.round("progress", 6).alias("progress"))


@query("k3_overall_progress", "v_progress", sql="with p as (select task, case when arg_max(status, cur) = 'purchase' then 1.0e0 else least(1, max(cur * 0.9e0 / total)) end as p from v_progress group by task) select round(5 + 90 * sum(p) / count(*), 4) as overall from p")
def overall_progress(progress: DataFrame) -> DataFrame:
    return live.overall(live.latest(progress.withColumn("current", F.col("cur") * 0.9))).select(F.round("overall", 4).alias("overall"))


@query("k4_task_eta", "v_progress", sql="select task, round(date_diff('microsecond', min(ts), max(ts)) / 1.0e6 / max(cur) * (max(total) * 2 - max(cur)), 3) as eta from v_progress group by task")
def task_eta(progress: DataFrame) -> DataFrame:
    seconds = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    return progress.groupBy("task").agg(F.round(seconds / F.max("cur") * (F.max("total") * 2 - F.max("cur")), 3).alias("eta"))


@query("k7_stalls", "v_progress", sql="select task, cur, round(date_diff('microsecond', ts, lead(ts) over (partition by task order by cur)) / 1.0e6, 3) as gap from v_progress qualify date_diff('microsecond', ts, lead(ts) over (partition by task order by cur)) / 1.0e6 > 36000")
def stalls(progress: DataFrame) -> DataFrame:
    return live.stalls(progress.withColumn("ts", F.col("ts").cast("timestamp")), 36_000).select("task", "cur", F.round("gap", 3).alias("gap"))


@query("k12_periodic_reports", "events", sql="select user_id, time_bucket(interval '1 day', ts) as at, arg_max(event_id, (ts, event_id)) as last from events group by all")
def periodic_reports(events: DataFrame) -> DataFrame:
    window = F.window(F.col("ts").cast("timestamp"), "1 day")
    out = events.groupBy("user_id", window.alias("w")).agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last"))
    return out.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("at"), "last")


@query("k5_throttled_messages", "v_progress")
def throttled_messages(progress: DataFrame) -> DataFrame:
    """Messages that a throttled sender gives out: it depends on what was sent before, so that it has no SQL form."""
    events = progress.select("task", "cur", F.col("ts").cast("timestamp").alias("ts"), F.col("status").alias("file"), (F.col("cur") * 100.0 / F.col("total")).alias("progress"))
    return live.throttled(events, least_step=2.0, least_seconds=86_400.0)


@query("k6_rate_limited", "v_progress")
def rate_limited(progress: DataFrame) -> DataFrame:
    events = progress.select("task", "cur", F.col("ts").cast("timestamp").alias("ts"), F.lit("one").alias("file"), F.when(F.col("cur") == F.col("total"), 100.0).otherwise(0.0).alias("progress"))
    return live.throttled(events, least_step=1000.0, least_seconds=43_200.0)


@query("k8_latest_pending", "v_progress", sql="select task, arg_max(status, cur) as status, max(cur) as cur from v_progress group by task")
def latest_pending(progress: DataFrame) -> DataFrame:
    return live.pending(progress)
