"""Assignment by linked groups against that of the whole table."""

from __future__ import annotations

import numpy as np
import pytest

from geoledger.operators import scoring


@pytest.mark.parametrize("share", [0.02, 0.1, 0.5])
def test_groups_give_what_the_whole_table_gives(share):
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, m = rng.integers(1, 14, 2)
        gain = np.where(rng.random((n, m)) < share, rng.random((n, m)), 0.0)
        whole = [(i, j) for i, j in scoring.assigned(np.where(gain >= 0.3, -gain, 1e5)) if gain[i, j] >= 0.3]
        assert scoring.assigned_above(gain, 0.3) == whole


def test_an_assignment_is_asked_for_linked_boxes_only(monkeypatch):
    """Two hundred boxes that meet their own track only need no table of them all."""
    seen = []
    monkeypatch.setattr(scoring, "assigned", lambda cost: seen.append(cost.shape) or [(0, 1), (1, 0)])
    gain = np.eye(200) * 0.9
    gain[4, 5] = gain[5, 4] = 0.8
    live = [[k, np.array([10.0 * k, 0, 10.0 * k + 9, 9]), 1, 0] for k in range(200)]
    tracks, _, fresh = scoring.follow(live, 200, np.array([t[1] for t in live]), 0.3, 2, 1, "assignment")
    assert tracks == list(range(200)) and fresh == 200 and seen == []
    assert len(scoring.assigned_above(gain, 0.3)) == 200 and seen == [(2, 2)]


def test_equal_gains_may_go_either_way_but_are_as_good():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, m = rng.integers(1, 9, 2)
        gain = rng.choice([0.0, 0.0, 0.5, 0.75, 1.0], (n, m))
        whole = [gain[i, j] for i, j in scoring.assigned(np.where(gain >= 0.3, -gain, 1e5)) if gain[i, j] >= 0.3]
        groups = scoring.assigned_above(gain, 0.3)
        assert len(groups) == len(whole) == len({i for i, _ in groups}) == len({j for _, j in groups})
        assert sum(gain[p] for p in groups) == pytest.approx(sum(whole))
