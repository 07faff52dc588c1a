"""Shapes of the engine's inputs derived from the driver's tables, as one SQL text for Spark and DuckDB each."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # Cells with a class before and after, eight scenes for each run of 65,536 order keys; a missing cell has no data.
    "v_cells": """select scene_id, r, c, min(cls) as pre_class, max(cls) as post_class from (select cast(floor(l_orderkey / 65536.0e0) as bigint) * 8 + l_suppkey % 8 as scene_id,
 (l_orderkey * 7) % 64 as r, l_partkey % 64 as c, cast(floor(l_quantity) as int) % 14 as cls from {lineitem}) t group by scene_id, r, c""",
    # Rectangles on the grid, with overlaps.
    "v_polygons": """select s_suppkey as fid, cast(floor(s_suppkey / 128.0e0) as bigint) * 8 + s_suppkey % 8 as scene_id, (s_suppkey * 5) % 48 as x0, (s_suppkey * 11) % 48 as y0,
 (s_suppkey * 5) % 48 + 4 + s_suppkey % 12 as x1, (s_suppkey * 11) % 48 + 4 + s_nationkey % 12 as y1 from {supplier}""",
    # Adjacent squares in source order.
    "v_provinces": """select n_nationkey as ord, n_name as name, (n_nationkey % 5) * 13 as x0, cast(floor(n_nationkey / 5.0) as int) * 13 as y0,
 (n_nationkey % 5) * 13 + 13 as x1, cast(floor(n_nationkey / 5.0) as int) * 13 + 13 as y1 from {nation}""",
    # Boxes of images with five categories: truth or detection.
    "v_boxes": """select ((l_orderkey * 100003 + l_partkey) * 10007 + l_suppkey) * 8 + l_linenumber as box_id, cast(floor(l_orderkey / 8.0e0) as bigint) as image_id, l_suppkey % 5 as category_id,
 case when l_returnflag = 'R' then 1 else 0 end as is_gt, cast(l_partkey % 200 as double) as x0, cast((l_suppkey % 100) * 2 as double) as y0,
 cast(l_partkey % 200 + l_quantity + 1.0 as double) as x1, cast((l_suppkey % 100) * 2 + l_linenumber * 6.0 as double) as y1,
 ((l_partkey * 31 + l_suppkey * 17) % 1000) / 1000.0e0 as score from {lineitem}""",
    "v_anns": """select l_orderkey as image_id, l_linenumber as ann_no, l_suppkey % 80 as category_id, case when l_discount < 0.02 then 1 else 0 end as iscrowd from {lineitem}""",
    "v_scene_files": """select o_orderkey as scene_key, concat('S_', cast(o_orderkey as string), '_', cast(extract(year from o_orderdate) as string)) as stem,
 case when o_orderstatus in ('O','F') then 1 else 0 end as has_pre, case when o_orderstatus in ('F','P') then 1 else 0 end as has_post,
 case when o_orderstatus = 'F' then 1 else 0 end as has_vector from {orders}""",
    "v_progress": """select user_id as task, ts, event_id, event_type as status, value, cast(row_number() over (partition by user_id order by ts, event_id) as bigint) as cur,
 count(*) over (partition by user_id) as total from {events}""",
    "v_scalars": """select event_type as name, cast(row_number() over (partition by event_type order by ts, event_id) as bigint) as iter, value from {events}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or one of the driver's tables."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    used = {t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", VIEWS[name])}
    return spark.sql(VIEWS[name], **used)


def duck(sql: str) -> str:
    """``sql`` with the views it names defined before it."""
    named = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not named:
        return sql
    with_ = ", ".join(f"{v} as ({VIEWS[v].format(**{t: t for t in TABLES})})" for v in named)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {with_}, {body[15:]}"
    return f"with {with_}, {body[5:]}" if body.lower().startswith("with ") else f"with {with_} {body}"
