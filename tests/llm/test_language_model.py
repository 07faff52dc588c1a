"""The language model: exact base scores at any dictionary, and Baum-Welch over all training texts until it settles."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pytest

from geoledger.llm import hmm

KIND = "doc_id long, text binary, uid long, shard string"


def base(texts: list[bytes]) -> dict[int, tuple]:
    words = {i: [*(t or b"").lower().split(), b"\n"] for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = counts.total(), len(counts)
    return {i: (len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in words.items()}


def check(spark, texts, **bounds):
    rows = hmm.score_documents(spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], KIND), **bounds).collect()
    want = base(texts)
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


@pytest.mark.parametrize("dictionary", [1, 20, 200_000])
def test_base_scores_at_any_dictionary(spark, dictionary):
    rng = random.Random(1)
    words = [f"W{k}".encode() for k in range(250)] + [b"\xff\xfe", "é".encode(), b"\xc2\xa0"]
    texts = [b" ".join(rng.choices(words, k=rng.randrange(0, 90))) + rng.choice([b"", b"\r\n", b" \x0b"]) for _ in range(60)] + [b"", None, b" \t\n", b"lone"]
    check(spark, texts, dictionary=dictionary, words=10)


def test_a_text_of_many_words_that_are_all_as_frequent(spark):
    check(spark, [b" ".join(b"w%d" % k for k in range(30_000)), b"w1 other"], dictionary=2_000, words=500)


def test_dictionary_holds_about_as_many_words_as_it_may(spark):
    counts = spark.createDataFrame([(b"w%d" % k, 1 + (k < 3)) for k in range(50_000)], "w binary, c long")
    voc = hmm.vocabulary(counts, 10_000, 1_000)
    assert 9_500 < len(voc.words) < 10_500 and 900 < voc.singles < 1_100
    assert {b"w0", b"w1", b"w2"} <= set(voc.words[:3])
    assert counts.where(~voc.listed).count() == 50_000 - len(voc.words)


def test_rounds_read_all_training_texts_and_end_when_they_gain_little(spark):
    rng = random.Random(2)
    texts = []
    for k in range(200):
        texts.append(" ".join(rng.choices("abcdefgh"[4 * (k % 2) :][:4], k=rng.randrange(20, 120))).encode())
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], KIND)
    counts = hmm._counts(docs, "doc_id", "text", 7, 2)
    voc = hmm.vocabulary(counts)
    model = hmm.train(hmm._encoded(docs, voc, "doc_id", "text", 7, 2), voc)
    gains = [b - a for a, b in zip(model.history, model.history[1:])]
    assert 2 <= len(model.history) < hmm.MOST_ROUNDS and gains[-1] < hmm.GAIN and all(g >= hmm.GAIN for g in gains[:-1])
    # Which of the two halves of the alphabet a text is in is worth log10(2) a word over the words' frequencies.
    n = voc.n_tokens
    alone = sum(r["c"] * math.log10(r["c"] / n) for r in counts.collect()) / n
    assert model.history[-1] > alone + 0.2
