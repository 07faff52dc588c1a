"""Collocations against brute force, and the filters' round trips."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from geoledger.llm import phrases


def plain(rows, least, longest=5, share=100):
    """{(lang, phrase): (a, l, r, n, score)} by counting all phrases."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", text):
            ws = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = {}
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in often.items():
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items())
            if not inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                out[lang, b" ".join(p).decode()] = (a, counts[p[:k]], counts[p[k:]], n[lang], score)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["The", "of", "new", "York", "city", "é", "\xa0", "state", "x-1", "(a)", "rare"]
    out = []
    for k in range(150):
        parts = [" ".join(rng.choices(words, weights=range(11, 0, -1), k=rng.randrange(0, 12))) for _ in range(4)]
        out.append((rng.choice(["en", "de", None, "und"]), rng.choice([" \t", ", ", ".", "\n", "\x0b"]).join([*parts, "new york  city state of", "no\ta no a no a no"])))
    return [*out, ("en", None), ("en", ""), (None, " \t"), ("xx", "alone"), out[0], out[0]]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, rows, small):
    if small:  # several stretches, rows and flushes, most words beyond the head of the dictionary, a Bloom filter that is full
        for name, value in (("HEAD", 3), ("STRETCH", 200), ("ROW", 7), ("ENTRIES", 16), ("MERGED", 300), ("BLOOM_BITS", 64)):
            monkeypatch.setattr(phrases, name, value)
    df = spark.createDataFrame([(k, t, g, 1, "clash") for k, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, ids string").repartition(3)
    want = plain(rows, 8)
    found = phrases.collocations(df, least=8).collect()
    assert {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found} == want and len(found) == len(want) > 20
    best = phrases.best_phrases(df, most=5, least=8).collect()
    for lang in ("en", "de", "und"):
        order = sorted((-v[4], -v[0], p.encode()) for (g, p), v in want.items() if g == lang)[:5]
        assert [r["phrase"].encode() for r in sorted(best, key=lambda r: r["rank"]) if r["lang"] == lang] == [p for _, _, p in order]


def test_share_below_all(spark, rows):
    df = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string")
    found = {(r["lang"], r["phrase"]) for r in phrases.collocations(df, least=8, share=70, longest=4).collect()}
    assert found == set(plain(rows, 8, 4, 70))


def test_nothing_frequent(spark):
    for rows in ([], [("one two", "en")], [(None, None)]):
        df = spark.createDataFrame(rows, "text string, lang string")
        assert phrases.best_phrases(df).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and phrases.best_phrases(df).isEmpty()


def test_products_beyond_64_bits(spark):
    n, a, one = 10**12, 4 * 10**11, 5 * 10**11
    assert 1000 * a * n > 1 << 64
    got = spark.sql(f"select cast((cast({a}L as decimal(17,0)) * cast({n}L as decimal(17,0)) * cast(1000 as decimal(4,0))) div (cast({one}L as decimal(19,0)) * cast({one - 1}L as decimal(19,0))) as bigint) as x").first()["x"]
    assert got == 1000 * a * n // (one * (one - 1))


def test_long_texts_and_words(spark):
    text = "q" * 300_000 + " " + "aa bb " * 20_000 + ", aa"
    found = {r["phrase"]: (r["a"], r["l"], r["r"]) for r in phrases.collocations(spark.createDataFrame([(text, "en")], "text string, lang string"), longest=2).collect()}
    assert found == {"aa bb": (20_000, 20_001, 20_000), "bb aa": (19_999, 20_000, 20_001)}


@pytest.mark.parametrize("bits, words", [(1, 2), (5, 3), (16, 4), (16, 5), (17, 5), (21, 4), (25, 5), (32, 2), (32, 4)])
def test_permutation_is_lossless(bits, words):
    rng = np.random.default_rng(bits)
    columns = [rng.integers(0, 1 << bits, 500) for _ in range(words)]
    q, r = phrases.pack(columns, bits)
    assert all((a == b).all() for a, b in zip(phrases.unpack(q, r, words, bits), columns, strict=True))
    assert len(np.unique(np.stack((q, r), 1), axis=0)) == len(np.unique(np.stack(columns, 1), axis=0))


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    q, r = rng.integers(0, 50, 4000).astype(np.uint64) << np.uint64(40), rng.integers(0, 9, 4000).astype(np.uint64)
    parts = [phrases.tally(q[k::4], r[k::4]) for k in range(4)]
    back = [phrases.from_bytes(phrases.to_bytes(*p)) for p in parts]
    assert all((x == y).all() for p, b in zip(parts, back, strict=True) for x, y in zip(p, b, strict=True))
    merged = phrases.tally(*[np.concatenate(x) for x in zip(*back, strict=True)])
    merged = phrases.from_bytes(phrases.to_bytes(merged[0], merged[1], merged[2] * 1000))
    assert dict(zip(zip(merged[0].tolist(), merged[1].tolist()), (merged[2] // 1000).tolist(), strict=True)) == Counter(zip(q.tolist(), r.tolist()))
    assert [len(x) for x in phrases.from_bytes(phrases.to_bytes(*phrases.tally(q[:0], r[:0])))] == [0, 0, 0]


def test_too_many_words_say_so():
    with pytest.raises(ValueError):
        phrases.pack([np.zeros(1, np.int64)] * 5, 26)
