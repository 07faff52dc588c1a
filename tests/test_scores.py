"""Fingerprints as files pass, and values of scoring queries that have no SQL twin."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from geoledger.operators import runs
from geoledger.plans import catalog


def test_fingerprints_against_a_plain_reading(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice(["x", "é", "z\n", None]) and f"p{rng.randrange(40)}é", rng.choice([None, 5, 7]), rng.randrange(4)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "run string, part long, path string, size long, mtime long").repartition(6)
    want: dict = {}
    for run, part, *file in rows:
        want.setdefault((run, part), []).append("|".join(str(f) for f in file if f is not None))
    want = {k: hashlib.sha256("\n".join(sorted(v, key=str.encode)).encode()).hexdigest() for k, v in want.items()}
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        found = runs.fingerprint(df, ["run", "part"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert len(found) == len(want) == 9 and {(r["run"], r["part"]): r["fingerprint"] for r in found} == want
    one = runs.fingerprint(df.where("run = 'a'").withColumn("run", F.lit("a")), ["run"]).collect()
    assert len(one) == 1
    assert runs.fingerprint(df.limit(0), ["run"]).count() == 0


def test_classes_of_a_model_against_a_plain_reading(spark, sf_dir):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()}
    weights = np.cos(np.arange(640.0)).reshape(64, 10)
    want = {k: int(np.argmax((np.array(v, float) @ weights).astype(np.float32))) for k, v in vectors.items()}
    assert {r["vec_id"]: r["cls"] for r in catalog.queries()["u1_model_scores"](spark, sf_dir).collect()} == want
