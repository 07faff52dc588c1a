"""Results in odd cases: dense tries, repeated ids, texts that are no UTF-8, votes, and many exceptions."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoledger.llm import mixing, pieces, quality, queries, simhash, toxicity
from geoledger.operators.graph import connected_components
from tests.llm.test_operators import component_ids, plain_fingerprint

TEXTS = [b"A \xff\xfe b", b"\xc3", b"plain words of a text", None, b""]


@pytest.mark.parametrize(("subtree", "heavy"), [(8192, 1 << 15), (64, 1 << 15), (64, 60)])
def test_trie_by_shuffle_finds_all_links(spark, subtree, heavy):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    flips = lambda k: np.uint64(sum(1 << int(i) for i in rng.choice(64, k, replace=False)))
    # A third shares its upper bits, in any of the three parts; some near copies each.
    dense = [np.uint64(0x123456789ABCDEF0) ^ np.uint64(int(rng.integers(0, 1 << 12)) << s) for s in (0, 21, 42) for _ in range(60)]
    near = [b ^ flips(int(rng.integers(1, 6))) for b in [*base, *dense] for _ in range(2)]
    keys = np.unique(np.concatenate((base, np.array(dense, np.uint64), np.array(near, np.uint64)))).view(np.int64)
    fps = spark.createDataFrame([(int(k),) for k in keys], "fp long")
    found = {r["node"]: r["component"] for r in connected_components(simhash.near_links(fps, 4, subtree, heavy)).collect()}
    want = component_ids(sorted(int(k) for k in keys), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    groups = lambda of: {frozenset(k for k in of if of[k] == v) for v in of.values()}
    assert groups({int(k): found.get(int(k), int(k)) for k in keys}) == groups(want)


def test_representatives_of_repeated_and_null_ids(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choices([f"w{k}" for k in range(500)], k=60)) for _ in range(3))
    assert (plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() > 4
    rows = [(5, a, "x"), (5, b, "x"), (3, b, "y"), (5, a, "x"), (None, c, "z"), (None, c, "z"), (None, a, "z"), (7, "", "e"), (8, None, "e"), (9, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = [(r["doc_id"], r["text"], r["fp"]) for r in simhash.representatives(df).collect()]
    assert sorted(kept, key=str) == sorted([(5, a, "x"), (3, b, "y"), (None, c, "z"), (7, "", "e")], key=str)
    assert simhash.representatives(df.limit(0)).collect() == []


def test_texts_that_are_no_utf8(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, t binary").select("doc_id", F.col("t").cast("string").alias("text"))
    rows = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert [rows[k]["n_words"] for k in range(5)] == [3, 1, 5, 0, 0] and rows[0]["word_chars"] == 4
    labels = spark.createDataFrame([(2, 1)], "doc_id long, toxic int")
    assert toxicity.score_documents(df, labels).count() == 5
    assert simhash.near_duplicates(df).count() == 5


def test_verdicts_against_plain_estimation(spark):
    rng = random.Random(9)
    good = [" ".join(["the", "of", *(f"name{rng.randrange(900)}" for _ in range(8))] * 3) + f" end{k}." for k in range(30)]
    good += [" ".join(f"{rng.choice(['the', 'of', 'and', 'river', 'house', 'green'])}" if j % 2 else f"thing{rng.randrange(3000)}" for j in range(60)) for _ in range(50)]
    bad = [" ".join(rng.choice(["$$$", "BUY!!", "x###", "&", "NOW"]) + str(rng.randrange(9)) for _ in range(50)) for _ in range(25)]
    texts = good + bad + ["", "one two", None]
    votes = [quality.votes(t, quality.base_counts(t)) for t in texts if t]
    # The same estimation text by text, in plain Python.
    belief = [min(0.95, max(0.05, 0.9 - 0.4 * v.count(2))) for v in votes]
    for _ in range(200):
        share = (sum(belief) + 1) / (len(votes) + 2)
        chance = []
        for side in (0, 1):
            weight = [b if side else 1 - b for b in belief]
            counts = [[1 + sum(w for w, v in zip(weight, votes) if v[r] == x) for x in (1, 2)] for r in range(len(quality.RULES))]
            chance.append([[1.0, g / (g + d), d / (g + d)] for g, d in counts])
        new = []
        for v in votes:
            p = [np.prod([chance[side][r][x] for r, x in enumerate(v)]) * (share if side else 1 - share) for side in (0, 1)]
            new.append(p[1] / (p[0] + p[1]))
        change = max(abs(a - b) for a, b in zip(belief, new))
        if change < 1e-9:
            break
        belief = new
    sure = iter(new)
    want = [bool(t) and next(sure) >= 0.5 for t in texts]
    rows = quality.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [w and not r["base_failed"] for w, r in zip(want, rows)]
    assert 0 < sum(r["kept"] for r in rows) < len(texts)


def plain_sums(text: str, weights: dict, exceptions: list) -> float:
    words = [k for k in range(len(text)) if text[k].isalpha() and not (k and text[k - 1].isalpha())]
    ends = lambda k: k >= len(text) or not text[k].isalpha()
    total = 0.0
    for k in words:
        fits = [w for e, w in weights.items() if text.startswith(e.rstrip("."), k) and (not e.endswith(".") or ends(k + len(e) - 1))]
        inside = any(text.startswith(x, a) and (not a or not text[a - 1].isalpha()) and ends(a + len(x)) for x in exceptions for a in range(max(0, k - len(x) + 1), k + 1))
        total += max(fits, default=0.0) * (not inside)
    return total


def test_lexicon_against_plain_matching():
    rng = random.Random(7)
    lexicon = toxicity.Lexicon({"ab": 1.5, "abc": 2.0, "bad.": 3.0, "ca": 0.5, "dab": 1.0}, ("abacus", "ca ab", "bad day", "x bad ab"))
    machine = lexicon.automaton()
    for _ in range(3000):
        text = " ".join(rng.choice(["ab", "abacus", "abc", "bad", "bads", "day", "ca", "x", "dab", "cab", "a,b"]) for _ in range(rng.randrange(0, 12)))
        assert toxicity.sums(text, machine)[0] == pytest.approx(plain_sums(text, lexicon.weights, list(lexicon.exceptions)))


def test_many_exceptions_in_one_text_take_linear_time():
    machine = toxicity.Lexicon({"ab": 1.0}, ("abacus",)).automaton()
    start = time.time()
    assert toxicity.sums("abacus ab " * 40_000, machine)[0] == 40_000
    assert time.time() - start < 3


def test_rates_against_bisection(spark):
    rng = random.Random(12)
    rows = [(k, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "b", "c", "d"])) for k in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in "abcd":
        mine = [r for r in found if r["source"] == source and r["size"]]
        target = mine[0]["target"]
        low, high = -50.0, 50.0
        for _ in range(200):
            x = (low + high) / 2
            low, high = (x, high) if sum(r["size"] * min(2, math.exp(min(x * r["size"], 1))) for r in mine) < target else (low, x)
        for r in mine:
            assert r["rate"] == pytest.approx(min(2, math.exp(min(x * r["size"], 1))), rel=1e-4)


def test_many_equal_rows_are_mixed_like_others(spark):
    rng = random.Random(13)
    rows = [(None, "a b c d", "s", 1)] * 400 + [(7, "a b c", "s", 2)] * 101 + [(k, " ".join(["w"] * rng.randrange(1, 40)), rng.choice("st"), 3) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    found = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(5)).collect()
    as_counted = lambda rows: Counter((r["doc_id"], r["text"], r["source"], r["copies"]) for r in rows)
    assert as_counted(found) == as_counted(again) and len(found) == len(rows)
    for source in "st":
        mine = [r for r in found if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 60
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in found)


def test_pieces_of_any_bytes_and_scores_of_the_file(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, t binary").select("doc_id", F.col("t").cast("string").alias("text"), F.lit(1).alias("ids"))
    rows = pieces.encode(df, queries.piece_model()).orderBy("doc_id").collect()
    assert all(r["decoded_ok"] for r in rows) and rows[3]["ids"] is None and rows[4]["ids"] == []
    plain = pieces.segmenter(queries.piece_model(), None)
    usual = pieces.segmenter(queries.piece_model())
    assert min(s for s, _ in plain.pieces.values()) < -1e8 < min(s for s, _ in usual.pieces.values())
    assert plain.encode("a plain text")[1] == usual.encode("a plain text")[1]
    assert plain.decode(plain.encode("two  spaces")[0]) == "two  spaces"
    s = pieces.Segmenter(queries.piece_model())
    for k in range(60_000):
        s.packed(f"word{k} of{k % 7}")
    assert sum(map(len, s._known)) + sum(map(len, s._older)) < 3 * pieces._KEPT
