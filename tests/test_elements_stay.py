"""Elements of JSON files stay in the task that read them, unless they cross a chunk's edge."""

from __future__ import annotations

import json

from geoledger.sources import elements, readers


def dealt(spark) -> int:  # noqa: ANN001
    """Rows that all shuffles so far wrote."""
    sc = spark.sparkContext
    none = lambda: sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none(), False, False, sc._gateway.new_array(sc._jvm.double, 0), none())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_text_is_not_dealt(spark, tmp_path):
    """Every piece was dealt four times before."""
    n = 20000
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"images": [{"id": k, "file_name": f"{k}}}"} for k in range(n)], "note": "}", "annotations": [{"id": k, "image_id": k, "v": [[{"a": [k]}]]} for k in range(n)]}))
    before = dealt(spark)
    found = elements.json_elements(spark, str(file), ["images", "annotations"]).selectExpr("count(*) as n", "count(distinct field, ord) as d", "sum(ord) as s", "count_if(cast(get_json_object(value, '$.id') as long) = ord) as same").first()
    assert tuple(found) == (2 * n, 2 * n, n * (n - 1), 2 * n)
    # The test's own distinct deals each row once.
    assert dealt(spark) - before < 3 * n


def test_chunks_smaller_than_elements(spark, tmp_path):
    docs = [{"annotations": [{"image_id": k, "segments_info": [{"id": s, "category_id": 5} for s in range(k % 4)]}, [{"x": {}}], {"image_id": -k - 1, "segments_info": []}]} for k in range(50)]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, docs)))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        found = readers.panoptic(spark, str(tmp_path), {5: 0}, {}).collect()
    finally:
        spark.conf.set(name, was)
    assert sorted((r["image_id"], r["segment_id"]) for r in found) == [(k, s) for k in range(50) for s in range(k % 4)]


def test_walk_of_parts():
    walk = lambda *x: [r[:4] for r in elements._walk(*x) if r[0] != "sum"]
    assert walk('x"}, {"id":2}, [{"a":1}], {"b":{', True, 3) == [("head", None, None, 'x"}'), ("whole", None, 0, '{"id":2}'), ("tail", None, 1, '{"b":{')]
    assert walk('}images": [{"a":1}], "other": {"x":{}}, "images": [{}', True, 1) == [("whole", "", 0, '{"a":1}'), ("whole", "", 0, "{}"), ("whole", "images", 0, "{}")]
    deep = '{"v":[[[[[[{"x":"]"}]]]]]]}'
    assert walk(f"{deep},{deep}", False, 2) == [("whole", None, k, deep) for k in (0, 1)]


def test_records_are_parsed_once(spark, tmp_path):
    """The text was parsed again for the check of ids, the categories and the records."""
    docs = [{"images": [{"id": k, "neg_category_ids": [k]}], "annotations": [{"id": 10 * k + a, "image_id": k, "category_id": a + 1} for a in range(3)]} for k in range(20)]
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, docs)))
    found = readers.lvis(spark, str(tmp_path))
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["image_id"], r["neg_category_ids"], [(a["id"], a["category_id"]) for a in r["annotations"]]) for r in found.collect()) == [(k, [k], [(10 * k + a, a) for a in range(3)]) for k in range(20)]
