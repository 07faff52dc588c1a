"""Queries of samples, batches and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.operators import sampling
from geoledger.plans.catalog import query


def _place(key: str, seed: str = "") -> str:
    return f"cast(concat('0x', substr(sha256(concat({key}, '|{seed}')), 1, 15)) as bigint)"


@query("f1_stratified_sample", "orders", sql=f"""with k as (select *, o_custkey % 4 as src, row_number() over (partition by o_custkey % 4, o_orderpriority order by {_place('o_orderkey')}, o_orderkey) as k from orders),
t as (select *, row_number() over (partition by src order by k, o_orderpriority) as turn from k where k <= 30) select src, o_orderpriority, o_orderkey from t where turn <= 30 order by turn, src limit 30""")
def stratified_sample(orders: DataFrame) -> DataFrame:
    some = orders.select((F.col("o_custkey") % 4).alias("src"), "o_orderpriority", "o_orderkey")
    return sampling.stratified(some, "src", "o_orderpriority", "o_orderkey", 30)


@query("f7_random_subset", "orders", sql=f"select o_orderkey from orders where {_place('o_orderkey', 's')} / 1152921504606846976.0e0 < 0.3")
def random_subset(orders: DataFrame) -> DataFrame:
    return sampling.subset(orders, "o_orderkey", 0.3, "s").select("o_orderkey")


@query("f8_stochastic_repeats", "orders", sql=f"""with f as (select o_orderkey, 0.5e0 + o_orderkey % 4 * 0.75 as f from orders), n as (select o_orderkey, cast(floor(f) + case when {_place('o_orderkey')} / 1152921504606846976.0e0 < f - floor(f) then 1 else 0 end as int) as n from f)
select o_orderkey, cast(unnest(range(1, n + 1)) as int) as copy from n""")
def stochastic_repeats(orders: DataFrame) -> DataFrame:
    return sampling.with_repeats(orders, "o_orderkey", 0.5 + F.col("o_orderkey") % 4 * 0.75).select("o_orderkey", "copy")


@query("f9_fixed_shuffle", "orders", sql=f"select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by {_place('o_orderkey', '7')}, o_orderkey) as at from orders")
def fixed_shuffle(orders: DataFrame) -> DataFrame:
    from pyspark.sql.window import Window

    order = Window.partitionBy("o_custkey").orderBy(sampling.place(F.col("o_orderkey"), "7"), "o_orderkey")
    return orders.select("o_custkey", "o_orderkey", F.row_number().over(order).cast("long").alias("at"))


@query("f10_balanced_labels", "v_boxes", sql=f"""with p as (select box_id, image_id, category_id, category_id <> 0 as positive, row_number() over (partition by image_id, category_id <> 0 order by {_place('box_id')}, box_id) as k from v_boxes where category_id <> 4),
t as (select *, least(coalesce(max(case when positive then k end) over (partition by image_id), 0), 4) as taken from p) select image_id, box_id, positive from t where (positive and k <= 4) or (not positive and k <= 16 - taken)""")
def balanced_labels(boxes: DataFrame) -> DataFrame:
    labelled = boxes.select("image_id", "box_id", F.when(F.col("category_id") == 4, -1).otherwise(F.col("category_id")).alias("label"))
    return sampling.balanced(labelled, "image_id", "box_id", "label", 16, 0.25, background=0).select("image_id", "box_id", "positive")


@query("f11_first_k", "events", sql="select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as k from events) where k <= 3")
def first_k(events: DataFrame) -> DataFrame:
    return sampling.per_group(events, "user_id", [F.asc("ts"), F.asc("event_id")], 3).select("user_id", "event_id")


@query("f12_k_per_class", "events", sql=f"select event_type, event_id from (select event_type, event_id, row_number() over (partition by event_type order by {_place('event_id')}, event_id) as k from events) where k <= 8")
def k_per_class(events: DataFrame) -> DataFrame:
    return sampling.per_group(events, "event_type", [sampling.place(F.col("event_id")), F.asc("event_id")], 8).select("event_type", "event_id")


@query("f13_confident_k", "events", sql=f"""with b as (select event_type, event_id, row_number() over (partition by event_type order by value desc, event_id) as k from events),
c as (select event_type, event_id, row_number() over (partition by event_type order by {_place('event_id')}, event_id) as n from b where k <= 40) select event_type, event_id from c where n <= 8""")
def confident_k(events: DataFrame) -> DataFrame:
    return sampling.confident(events, "event_type", "event_id", "value", 8, 5).select("event_type", "event_id")


@query("f14_ratio_mixing", "events", sql=f"select event_type, event_id from events where {_place('event_id', 'mix')} / 1152921504606846976.0e0 < case event_type when 'view' then 0.5 when 'click' then 0.25 else 0.1 end")
def ratio_mixing(events: DataFrame) -> DataFrame:
    ratio = F.when(F.col("event_type") == "view", 0.5).when(F.col("event_type") == "click", 0.25).otherwise(0.1)
    return events.where(sampling.uniform(F.col("event_id"), "mix") < ratio).select("event_type", "event_id")


@query("f15_points_in_boxes", "v_boxes", sql=f"""with e as (select box_id, x0, y0, x1, y1, i from v_boxes, range(0, 3) r(i) where is_gt = 1)
select box_id, cast(i as int) as i, cast(floor(x0 + {_place("concat(box_id, '|', i)", 'x')} / 1152921504606846976.0e0 * (x1 - x0)) as bigint) as px, cast(floor(y0 + {_place("concat(box_id, '|', i)", 'y')} / 1152921504606846976.0e0 * (y1 - y0)) as bigint) as py from e""")
def points_in_boxes(boxes: DataFrame) -> DataFrame:
    return sampling.points_in_boxes(boxes.where("is_gt = 1"), "box_id", 3).select("box_id", "i", "px", "py")


@query("e10_grouped_batches", "events", sql="""with b as (select user_id, event_id, (row_number() over (partition by user_id order by ts, event_id) - 1) // 8 as batch from events), n as (select *, count(*) over (partition by user_id, batch) as n from b) select user_id, batch, event_id from n where n = 8""")
def grouped_batches(events: DataFrame) -> DataFrame:
    return sampling.batches(events.withColumn("o", F.struct("ts", "event_id")), "user_id", "o", 8).select("user_id", "batch", "event_id")


@query("e11_contiguous_shards", "events", sql="select user_id, event_id, ntile(4) over (partition by user_id order by ts, event_id) - 1 as shard from events")
def contiguous_shards(events: DataFrame) -> DataFrame:
    return sampling.shards(events.withColumn("o", F.struct("ts", "event_id")), "user_id", "o", 4).select("user_id", "event_id", "shard")
