"""Segmentation of long words without a space, against the n best by dynamic programming."""

from __future__ import annotations

import heapq
import random
import tracemalloc

import numpy as np
import pytest

from geoledger.llm import pieces, queries

MODEL = queries.piece_model()


def word(n: int) -> str:
    return "".join(random.Random(11).choices("acgtACGTetaoin", k=n))


def n_best_scores(s, full, n):
    at = [[] for _ in range(len(full) + 1)]
    at[0] = [0.0]
    for a, here in enumerate(s.edges(full)):
        for b, score, _ in here:
            at[b] = heapq.nlargest(n, at[b] + [x + score for x in at[a]])
    return at[-1]


def test_memory_of_n_best_grows_with_the_word():
    s, full = pieces.segmenter(MODEL), "▁" + word(8_000)
    s.nbest_of("▁the", 3)
    tracemalloc.start()
    s.nbest_of(full, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6


@pytest.mark.parametrize("text", [word(200_000), "x" * 200_000])
def test_word_of_200_000_letters(text):
    s, full = pieces.segmenter(MODEL), "▁" + text
    ids, scores = s.packed(text, 3)
    assert scores == n_best_scores(s, full, 3)
    assert s.decode(np.frombuffer(ids, np.int32).tolist()) == text
    best = s.nbest_of(full, 3)
    assert list(best[0][1]) == np.frombuffer(ids, np.int32).tolist() and len({i for _, i in best}) == 3
    assert all(s.decode(list(i)) == text for _, i in best) and full not in s._known
