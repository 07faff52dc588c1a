"""Components and patches of all scenes against brute force."""

from __future__ import annotations

from collections import Counter

from geoledger.plans import catalog
from geoledger.plans.views import view


def flooded(cells: dict) -> Counter:
    """(scene, first cell, cells) of each 4-connected region of equal value."""
    out, seen = Counter(), set()
    for start in sorted(cells):
        if start in seen:
            continue
        seen.add(start)
        todo, n = [start], 0
        while todo:
            s, r, c = todo.pop()
            n += 1
            for near in ((s, r - 1, c), (s, r + 1, c), (s, r, c - 1), (s, r, c + 1)):
                if near not in seen and cells.get(near) == cells[start]:
                    seen.add(near)
                    todo.append(near)
        out[start[0], start[1] * 64 + start[2], n] += 1
    return out


def test_components_of_all_scenes(spark, sf_dir):
    found = view(spark, sf_dir, "v_cells").collect()
    want = flooded({(x["scene_id"], x["r"], x["c"]): x["post_class"] % 3 for x in found if x["post_class"] % 3})
    rows = catalog.queries()["h38_all_components"](spark, sf_dir).collect()
    assert len({x["scene_id"] for x in rows}) == 8
    assert Counter((x["scene_id"], x["label"], x["cells"]) for x in rows) == want


def test_patches_of_all_scenes(spark, sf_dir):
    cells = {(x["scene_id"], x["r"], x["c"]): x["post_class"] for x in view(spark, sf_dir, "v_cells").collect()}
    edge = lambda k: min(max(k, 0), 63)
    want = Counter()
    for s, r, c in cells:
        near = [cells.get((s, edge(r + dy), edge(c + dx))) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
        here = [v for v in near if v is not None]
        want[s, r, c, sum(here), len(here)] += 1
    rows = catalog.queries()["h42_all_patches"](spark, sf_dir).collect()
    assert len({x["scene_id"] for x in rows}) == 8
    assert Counter((x["scene_id"], x["r"], x["c"], x["total"], x["cells"]) for x in rows) == want
