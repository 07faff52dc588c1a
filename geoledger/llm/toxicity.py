"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding undoes disguises: case, homoglyphs of other scripts, and digits or signs put for letters. The lexicon is learned
from labelled texts: words and beginnings of words that are far more frequent in toxic texts, weighted by their log-odds.
Words of clean texts that contain an entry are learned as exceptions; others can be given as phrases. A
match that an exception covers doesn't count. The weights' sum, alone and by length, gives the probability through a
logistic curve fitted on the same texts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.llm.words import raw
from geoledger.scratch import written

# Characters read as Latin letters. Cyrillic, Greek, then digits and signs.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s",
    "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "һ": "h", "ӏ": "l", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
    "​": None, "‌": None, "‍": None, "­": None, "﻿": None,
}
#: Full-width forms are shifted to ASCII.
_TABLE = str.maketrans(_LOOKALIKES | {chr(c + 0xFEE0): chr(c).lower() for c in range(0x21, 0x7F)})
_FOLDS = re.compile("[" + re.escape("".join(map(chr, _TABLE))) + "]")
_WORD = re.compile(r"[^\W\d_]+")

#: Labelled texts used at most, by label: the bound of the sample that the lexicon and the curve are fitted on.
TOXIC_TEXTS, CLEAN_TEXTS = 6000, 12000
#: An entry is in so many toxic texts of the sample at least; its log-odds, and those less two standard errors, are at least these.
LEAST_TEXTS, LEAST_WEIGHT, LEAST_SURE = 4, 2.5, 2.5
#: Texts whose sketches agree in this share of their places are copies.
COPY = 0.8
_MULTIPLIERS = np.random.default_rng(17).integers(0, 1 << 63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BEGINNINGS = range(4, 9)
#: Features that a worker counts before it sends the counts on; texts that it scores at a time.
_COUNTED, _ROWS = 150_000, 1000


def fold(text: str) -> str:
    """Lower case, with look-alikes read as the letters they stand for."""
    text = text.lower()
    return text.translate(_TABLE) if _FOLDS.search(text) else text


def features(folded: str) -> set[str]:
    """Words (with a full stop at their end) and beginnings of words."""
    words = set(_WORD.findall(folded))
    return {w + "." for w in words} | {w[:n] for w in words for n in _BEGINNINGS if len(w) >= n}


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve from a text's sums to a probability."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 1.0]))

    def automaton(self) -> ahocorasick.Automaton | None:
        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(entry.rstrip("."), (len(entry.rstrip(".")), weight, entry.endswith(".")))
        for phrase in map(fold, self.exceptions):
            if phrase not in self.weights and phrase + "." not in self.weights:
                out.add_word(phrase, (len(phrase), 0.0, True))
        if not len(out):
            return None
        out.make_automaton()
        return out


def sums(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, float]:
    """(sum of the weights, the same by the square root of hundreds of words).

    Entries count at the start of a word, one a word: the heaviest; whole-word entries must end it too.
    """
    if automaton is None:
        return 0.0, 0.0
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight, whole) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalpha() or whole and end + 1 < len(folded) and folded[end + 1].isalpha():
            continue
        if weight:
            best[start] = max(best.get(start, 0.0), weight)
        else:
            spared.append((start, end))
    if spared and best:
        # The furthest end of the exceptions that begin at or before a place tells whether one covers it.
        spared.sort()
        starts, ends, furthest = [a for a, _ in spared], [], -1
        for _, end in spared:
            furthest = max(furthest, end)
            ends.append(furthest)
        best = {s: w for s, w in best.items() if not (k := bisect_right(starts, s)) or ends[k - 1] < s}
    total = sum(best.values())
    return total, total / max(1.0, (folded.count(" ") + 1) / 100) ** 0.5


def probability(total: np.ndarray, by_length: np.ndarray, curve: np.ndarray) -> np.ndarray:
    x = curve[0] + curve[1] * np.log1p(total) + curve[2] * np.log1p(by_length)
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; without both labels the curve is flat."""
    if len(y) == 0 or y.min() == y.max():
        return np.array([-3.0 if not len(y) or y[0] == 0 else 3.0, 0.0, 0.0])
    x = np.column_stack((np.ones(len(x)), np.log1p(x)))
    w, ridge = np.zeros(3), np.diag([1e-6, 0.05, 0.05])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return w


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of at most TOXIC_TEXTS and CLEAN_TEXTS labelled rows, chosen by a hash of the id."""
    labels = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("i")).agg(F.max("toxic").alias("toxic"))
    picked = [labels.where((F.col("toxic") > 0) == F.lit(bool(y))).orderBy(F.xxhash64("i"), "i").limit(n) for y, n in ((1, TOXIC_TEXTS), (0, CLEAN_TEXTS))]
    chosen = picked[0].unionByName(picked[1])
    # At most 18,000 ids and labels: small enough for every executor, whatever the input.
    return docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t")).join(F.broadcast(chosen), "i").select("t", "toxic")


def sketch(text: bytes) -> tuple[int, np.ndarray]:
    """(least hash of a text's five-word sequences, their min-hash sketch): the share of equal places of two sketches tells how many sequences the texts share."""
    words = text.lower().split()
    h = np.array([xxhash.xxh64_intdigest(b" ".join(words[k : k + 5])) for k in range(max(1, len(words) - 4))], np.uint64)
    least = [(h[k : k + 4096, None] * _MULTIPLIERS).min(0) for k in range(0, len(h), 4096)]
    return int(h.min()) >> 1, np.min(least, 0)


def first_of_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (t, toxic, key, sketch) sorted by toxic and key: those whose sketch is not COPY like that of a kept row of the same toxic and key."""
    now, kept, n = None, np.empty((0, len(_MULTIPLIERS)), np.uint64), 0
    for b in batches:
        fine = []
        for toxic, key, s in zip(*[b.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
            if (toxic, key) != now:
                now, n = (toxic, key), 0
            s = np.frombuffer(s, np.uint64)
            new = not n or not ((kept[:n] == s).mean(1) >= COPY).any()
            if new:
                if n == len(kept):
                    kept = np.concatenate((kept, np.empty((max(8, n), len(s)), np.uint64)))
                kept[n], n = s, n + 1
            fine.append(new)
        yield b.select(["t", "toxic"]).filter(pa.array(fine, pa.bool_()))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", exceptions: tuple[str, ...] = ()) -> Lexicon:
    """The lexicon and its curve from the rows of ``labels`` (id_col, toxic) that have a text; an empty one if none has.

    Near copies say no more than one text: of labelled texts with the same least five-word sequence those count whose sketches
    agree with no other's in 80 % of their places. Texts that share a passage only all count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [Counter(), Counter()]

        def out() -> pa.RecordBatch:
            names = list(both[0].keys() | both[1].keys())
            columns = [pa.array([c[n] for n in names], pa.int64()) for c in both]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], names=["f", "clean", "toxic"])

        for b in batches:
            for text, toxic in zip(_texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                both[toxic].update(features(fold(text)))
                both[toxic][""] += 1
                if len(both[0]) + len(both[1]) > _COUNTED:
                    yield out()
                    both = [Counter(), Counter()]
        yield out()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sketches = zip(*map(sketch, b.column(0).to_pylist()), strict=True) if b.num_rows else ((), ())
            columns = [*b.columns, pa.array(keys, pa.int64()), pa.array([s.tobytes() for s in sketches], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["t", "toxic", "key", "sketch"])

    labelled = _sample(docs, labels, id_col, text_col).select("t", (F.col("toxic") > 0).cast("int").alias("toxic")).mapInArrow(keyed, "t binary, toxic int, key long, sketch binary")
    sorted_ = labelled.repartition("toxic", "key").sortWithinPartitions("toxic", "key", "t")
    sample = written(sorted_.mapInArrow(first_of_copies, "t binary, toxic int"), "labelled")
    counts = sample.mapInArrow(count, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Few features are in several toxic texts and hardly any clean one. There are no more than the bounded sample has.
    total = sample.agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    weight = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (total["clean"] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    telling = counts.where((F.col("f") != "") & (F.col("toxic") >= LEAST_TEXTS)).withColumn("w", weight)
    rows = telling.where((F.col("w") >= LEAST_WEIGHT) & (F.col("w") - 2 * error >= LEAST_SURE)).select("f", "w").orderBy("f").collect()
    weights = {r["f"]: r["w"] for r in rows}
    # A longer entry says no more than a shorter one that is as heavy.
    lean = {f: w for f, w in weights.items() if not any(weights.get(f[:n], 0) >= w - 0.7 for n in range(1, len(f.rstrip("."))))}
    lean = {f: w for f, w in lean.items() if not f.endswith(".") or f[:-1] not in lean}
    plain = Lexicon(lean)
    machine = plain.automaton()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [fold(t) for t in _texts(b.column(0))]
            found = [sums(t, machine) for t in texts]
            words = [sorted({w for w in _WORD.findall(t) if sums(w, machine)[0]}) if s else [] for t, (s, _) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([s for s, _ in found]), pa.array([s for _, s in found]), pa.array(words, pa.list_(pa.string()))], names=["y", "a", "b", "words"])

    rows = sample.mapInArrow(measure, "y int, a double, b double, words array<string>").collect()
    seen = [Counter(w for r in rows if r["y"] == y for w in r["words"]) for y in (0, 1)]
    innocent = tuple(sorted(w for w, n in seen[0].items() if n >= 3 and n > 20 * seen[1][w]))
    curve = _fit(np.array([(r["a"], r["b"]) for r in rows]).reshape(-1, 2), np.array([r["y"] for r in rows], float))
    return Lexicon(lean, (*exceptions, *innocent), curve)


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and a score from 0 to 1 of every row; null texts are scored as empty ones, bytes that are no UTF-8 as U+FFFD."""
    kept = [f for f in docs.schema if f.name in keep]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for b in (whole.slice(k, _ROWS) for whole in batches for k in range(0, whole.num_rows, _ROWS)):
            found = np.array([sums(fold(t), machine) for t in _texts(b.column(0))]).reshape(-1, 2)
            p = probability(found[:, 0], found[:, 1], lexicon.curve)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p)], names=[*[f.name for f in kept], "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*kept, StructField("score", DoubleType(), False)])
    return raw(docs, text_col, [f.name for f in kept]).mapInArrow(each, schema)


def _texts(column: pa.Array) -> Iterator[str]:
    """Null as empty; bytes that are no UTF-8 as U+FFFD."""
    return ((t or b"").decode(errors="replace") for t in column.to_pylist())


def fold_of(id_: F.Column, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; -1 for null."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds, F.lit(-1))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row; labels of held-out rows (fold 1 of 3) aren't looked at.

    Repeated rows are scored each; null ids are never held out; without labels every score is the same, below the
    threshold.
    """
    known = labels.where(fold_of(F.col(id_col), 3) != 1).select(id_col, "toxic")
    lexicon = learn(docs, known, id_col, text_col)
    out = score(docs, lexicon, text_col, (id_col,))
    return out.select(id_col, (fold_of(F.col(id_col), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
