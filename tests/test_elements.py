"""Arrays of JSON files read element by element over many splits."""

from __future__ import annotations

import json
import random

import pytest

from geoledger.sources import readers
from geoledger.sources.elements import json_elements

TRICKY = ['}', '{"a":[{', '"', "\\", '\\"}', "é}省", '],"annotations":[{"x":1}', "", "\n\t", "plain"]


def value(rng: random.Random, depth: int = 0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rng.choice(TRICKY)
    if kind < 3:
        return rng.choice([1, -2.5, None, True])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["images", "annotations", "a", "b}"]): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def document(rng: random.Random) -> dict:
    parts = [("images", [{"id": i, "v": value(rng)} for i in range(rng.randrange(40))]), ("info", {"images": [{"no": 1}], "t": rng.choice(TRICKY)})]
    parts += [("annotations", [1, None, "}", *({"id": i, "v": value(rng)} for i in range(rng.randrange(60)))]), ("note", rng.choice(TRICKY)), ("empty", []), ("other", [{"images": [{}]}, [{"x": {}}]])]
    rng.shuffle(parts)
    return dict(parts)


@pytest.mark.parametrize("split", ["90", "1000", "100000"])
def test_elements_of_files_in_splits(spark, tmp_path, split):
    rng = random.Random(11)
    want = {}
    for k in range(4):
        docs = [document(rng) for _ in range(1 if k else 3)]
        text = "\n".join(json.dumps(d, ensure_ascii=k % 2 == 0, indent=2 if k == 3 else None) for d in docs)
        (tmp_path / f"{k}.json").write_text(text + "\n" * (k == 2))
        for field in ("images", "annotations", "empty"):
            want[f"{k}.json", field] = [(i, e) for d in docs for i, e in enumerate(e for e in d[field] if isinstance(e, dict))]
    (tmp_path / "none.json").write_text("")
    (tmp_path / "bare.json").write_text("[1, 2]\n")
    was = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        if split == "90":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
        found = json_elements(spark, str(tmp_path), ["images", "annotations", "empty"]).collect()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    got: dict = {k: [] for k in want}
    for r in found:
        got[r["file"].rsplit("/", 1)[1], r["field"]].append((r["ord"], json.loads(r["value"])))
    key = lambda x: (x[0], json.dumps(x[1], sort_keys=True))
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in want.items()}
    assert sum(map(len, want.values())) > 200


def test_panoptic_segments(spark, tmp_path):
    file = tmp_path / "p.json"
    file.write_text(json.dumps({"annotations": [{"image_id": 3, "file_name": "}", "segments_info": [{"id": 1, "category_id": 5}, {"id": 2, "category_id": 9}, {"id": 4, "category_id": 7}]}], "categories": []}))
    found = readers.panoptic(spark, str(file), {5: 0}, {9: 1}).orderBy("segment_id").collect()
    assert [tuple(r) for r in found] == [(3, 1, 0, True), (3, 2, 1, False), (3, 4, None, False)]


def test_coco_file_in_splits(spark, tmp_path):
    anns = [{"id": i, "image_id": i % 7, "category_id": 3 + 2 * (i % 4), "bbox": [0, 0, i, 1], "iscrowd": 0, "segmentation": {"size": [4, 4], "counts": "}0"} if i % 5 == 0 else [[0, 0, 1, 0, 1, 1]]} for i in range(60)]
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"info": {"x": "{"}, "images": [{"id": i, "file_name": f"{i}}}", "height": 4, "width": 4} for i in range(8)], "annotations": anns, "categories": [{"id": c, "name": "n"} for c in (9, 7, 5, 3)]}))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = {r["image_id"]: r for r in readers.coco(spark, str(file)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert rows[7]["annotations"] is None and rows[3]["file_name"] == "3}"
    assert [(a["id"], a["category_id"], a["bbox"][2]) for k in range(7) for a in rows[k]["annotations"]] == [(i, i % 4, float(i)) for k in range(7) for i in range(k, 60, 7)]
