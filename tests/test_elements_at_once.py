"""Elements of JSON files are found and read a chunk at once, and aren't written as text."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from geoledger.sources import elements

KIND = "id bigint, image_id bigint, category_id int, name string, bbox array<double>, segmentation array<array<double>>"
PLAIN = ['{"id":1,"image_id":2,"category_id":3,"name":"a}é\\u00e9","bbox":[1,2.5,-0.0,1e-3],"segmentation":[[0.1,7],[]],"x":{"y":[{"id":9}]}}', "{}", '{ "id" : null,\n "bbox": [null, 5e-324, 0.30000000000000004] }', '{"i\\u0064":12345678901,"name":"2026-12-01"}']
ODD = ['{"id":1.0}', '{"id":"7","category_id":1}', '{"category_id":3000000000,"id":1}', '{"segmentation":{"size":[4,4],"counts":"}0"},"id":5}', '{"id":1,"id":2}', '{"name":17,"id":3}', '{"name":{"a":1},"id":4}', '{"bbox":[1e400,"NaN"],"id":6}', '{"bbox":["1"],"id":8}', '{"id":true}', '{"id":99999999999999999999}', "{'id':9}", '{"id":01}', '{"id":2,}', '{"bbox":[NaN,1],"id":3}']


def rows_written(spark) -> int:  # noqa: ANN001
    sc = spark.sparkContext
    none = lambda: sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none(), False, False, sc._gateway.new_array(sc._jvm.double, 0), none())
    return sum(stages.apply(k).outputRecords() for k in range(stages.size()))


def test_elements_are_not_written(spark, tmp_path):
    """A row was written for each element, with its text."""
    n = 5000
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"images": [{"id": k} for k in range(n)], "annotations": [{"id": k, "v": [{"a": "}"}]} for k in range(n)]}))
    before = rows_written(spark)
    found = elements.json_elements(spark, str(file), ["images", "annotations"])
    assert found.agg(F.count("*"), F.sum("ord"), F.count_if(F.get_json_object("value", "$.id").cast("long") == F.col("ord"))).first() == (2 * n, n * (n - 1), 2 * n)
    assert rows_written(spark) - before < 100


def test_records_are_those_of_from_json(spark, tmp_path):
    """Plain elements are read by Arrow, a chunk at once; others, and all of their chunk, by ``from_json``."""
    for k, each in enumerate([PLAIN, *[[o] for o in ODD], [*PLAIN, *ODD]]):
        (tmp_path / f"{k}.json").write_text('{"annotations":[%s],"other":[{"id":5}]}' % ",".join(each))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        schema = {"annotations": elements.StructType.fromDDL(KIND)}
        raw = elements._elements(spark, str(tmp_path), ["annotations"], schema, named=True).groupBy("file").agg(F.count("value").alias("texts"), F.count("annotations").alias("records")).collect()
        got = elements.json_records(spark, str(tmp_path), {"annotations": KIND}).select("ord", "annotations").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    counts = {r["file"].rsplit("/", 1)[1]: (r["texts"], r["records"]) for r in raw}
    assert counts["0.json"] == (0, len(PLAIN)) and counts["1.json"] == (1, 0) and counts[f"{len(ODD) + 1}.json"] == (len(PLAIN) + len(ODD), 0)
    texts = [(i, e) for each in [PLAIN, *[[o] for o in ODD], [*PLAIN, *ODD]] for i, e in enumerate(each)]
    want = spark.createDataFrame(texts, "ord long, value string").select("ord", F.from_json("value", KIND).alias("annotations")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_sizes_of_marks():
    """Places are those of bytes, also behind letters of several bytes and escapes."""
    text = 'é"}, {"a":"é\\"}{\\\\"}, {"b":[{}]}], "省": [{"c":"'
    assert [r[:4] for r in elements._walk(text, True, 3) if r[0] != "sum"] == [("head", None, None, 'é"}'), ("whole", None, 0, '{"a":"é\\"}{\\\\"}'), ("whole", None, 1, '{"b":[{}]}'), ("tail", "省", 0, '{"c":"')]
