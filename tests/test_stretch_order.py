"""Sums of fractions that are rounded to whole cells are taken in one order, so that reruns and other plans agree."""

from __future__ import annotations

import re

from geoledger.operators import raster


def test_sums_of_fractions_have_an_order(spark):
    cells = spark.createDataFrame([(1, r, c, (r * 7 + c * c) % 256) for r in range(8) for c in range(8)], "scene_id long, r long, c long, v int")
    plan = raster.stretch_table(cells, ["scene_id"], "v")._jdf.queryExecution().analyzed().toString()
    sums = re.findall(r"sum\(((?:[^()]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))*)\) windowspecdefinition\(([^()]*)", plan)
    assert sums
    for term, spec in sums:
        # Whole numbers (the counts n and flags) are exact in any order.
        whole = re.fullmatch(r"n#\d+L|CASE WHEN .* THEN cast\(.* as int\) END|cast\(.* as int\)|_w\d+#\d+L?", term)
        assert whole or " ASC" in spec, (term, spec)
    assert any(re.match(r"h#|CASE|_w", term) and " ASC" in spec for term, spec in sums)
