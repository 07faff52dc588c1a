"""Centre lines whose cells are bits of words: across the words' edges, and drawn without a group a chain."""

from __future__ import annotations

import random

from geoledger.operators import lines
from tests.test_lines import plain_thinned


def test_thinned_across_words(spark):
    """A row of a table of cells was sent to nine places in each turn before."""
    rng = random.Random(8)
    noise = {(r, c) for r in range(12) for c in range(50, 140) if rng.random() < 0.7}
    bars = {(r, c) for r in range(5) for c in range(120, 200)} | {(r, c) for r in range(30) for c in range(125, 131)}
    rows = [(s, r, c) for s, cells in enumerate((noise, bars)) for r, c in cells]
    found = lines.thinned(spark.createDataFrame(rows, "scene_id long, r int, c int"))
    assert found.schema["c"].dataType.simpleString() == "int"
    got = {tuple(x) for x in found.collect()}
    assert got == {(s, *p) for s, cells in enumerate((noise, bars)) for p in plain_thinned(cells)}
    assert found.sparkSession.read.parquet(*found.inputFiles()).count() < len(got)


def test_chains_are_rows(spark):
    """Each chain was a pandas group of its own before."""
    cells = spark.createDataFrame([(0, 3 * k, c) for k in range(40) for c in range(5)], "scene_id long, r long, c long")
    _, edges, members = lines.line_graph(cells)
    drawn = lines.lines_of(edges, members, 0.5)
    assert "FlatMapGroups" not in drawn._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["points"][0]["y"], [p["x"] for p in r["points"]]) for r in drawn.collect()) == [(3 * k + 0.5, [0.5, 4.5]) for k in range(40)]
