"""Exact substring dedup by seed and extend: words covered by a window that starts anywhere else are removed.

*Seed.* Each text's ``GRAM``-word hashes are winnowed: the least of each ``window - GRAM + 1`` neighbours is an anchor.
Two equal windows choose equal anchors, so a repeated window holds an anchor that is found at least twice. Beside each
anchor goes the hash of one window around it.

*Extend.* Texts are joined on their anchors. Where the windows at neighbouring anchors repeat too, the match already
reaches from one to the next. Where it does not, the anchor is open, and it is extended both ways: every text
that holds it gives all windows around it, word by word, and those found twice are the ends of the match.

*Keep.* The union of the repeated windows is the union of all maximal repeats of at least ``window`` words.

Nothing is paired: hashes are counted (with map-side combine) and joined back, so that a passage in a third of all
texts makes as many rows as it has occurrences. Equal texts are one class all through. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.llm.words import covered, hashes, runs_of, sliding_min
from geoledger.scratch import written

GRAM = 10
_COARSE = 0xD6E8FEB86659FD93
_NO_WORDS = hashlib.sha256(b"").hexdigest()


def anchors(h: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed anchors among the word hashes ``h``; none if there is no window."""
    if len(h) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    g, width = runs_of(h, gram), window - gram + 1
    least = sliding_min(g, width)
    edge = np.zeros(width - 1, np.uint64)
    most = ~sliding_min(~np.concatenate((edge, least, edge)), width)
    at = np.flatnonzero(most == g)
    return at, g[at]


def seeds(h: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors (places, hashes), and the windows around them and at the text's two ends (distinct starts, hashes)."""
    at, anchor = anchors(h, window, gram)
    if not len(at):
        return at, anchor, at, anchor
    last = len(h) - window
    start = np.unique(np.concatenate(([0, last], np.clip(at - (window - gram) // 2, 0, last))))
    return at, anchor, start, runs_of(h, window, _COARSE)[start]


def open_anchors(at: np.ndarray, anchor: np.ndarray, repeated: np.ndarray, done: np.ndarray, window: int, gram: int = GRAM) -> np.ndarray:
    """Hashes of the repeated anchors around which a window has a word that isn't ``done``."""
    n = len(done)
    at, anchor = at[repeated], anchor[repeated]
    left = np.cumsum(np.concatenate(([0], ~done)))
    first, last = np.maximum(at + gram - window, 0), np.minimum(at, n - window) + window
    return np.unique(anchor[left[last] > left[first]])


def _each(f: Callable, names: list[str]) -> Callable:
    """A function for mapInArrow that turns each row, as a tuple, into some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for row in zip(*(c.to_pylist() for c in b.columns), strict=True) for r in f(*row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c[0], np.ndarray) else _lists(c) for c in map(list, zip(*rows, strict=True))], names=names)

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _unsigned(x: list[int]) -> np.ndarray:
    return np.array(x, np.int64).view(np.uint64)


def _repeated(of: DataFrame, column: str) -> DataFrame:
    """(h): the values of an array column that occur more than once, copies of a text counted."""
    return of.select(F.explode(column).alias("h"), F.least("copies", F.lit(2)).alias("w")).groupBy("h").agg(F.sum("w").alias("w")).where("w > 1").select("h")


def repeats(docs: DataFrame, text_col: str = "text", window: int = 35) -> DataFrame:
    """(text_key, n_words, n_removed, kept binary or null, kept_sha256): one row per distinct text of ``docs``.

    ``text_key`` is :func:`text_key` of the text. ``kept`` is the kept words joined by one space; it is null where no
    word was removed (the text's own words are kept) and empty where all were. Null texts are as empty ones.
    """

    def first(key: bytes, text: bytes) -> Iterator[tuple]:
        words = text.split()
        at, anchor, start, coarse = seeds(hashes(words), window)
        yield key, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), at.astype(np.int32), _signed(anchor), start.astype(np.int32), _signed(coarse)

    source = docs.select(text_key(text_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    names = ["k", "n", "sha", "at", "anchor", "start", "coarse"]
    seeded = source.mapInArrow(_each(first, names), "k binary, n long, sha string, at array<int>, anchor array<long>, start array<int>, coarse array<long>")
    classes = written(seeded.groupBy("k").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in names[1:]]), "seeds")

    hits = classes.where("n >= " + str(window)).withColumn("h", F.concat("anchor", "coarse"))
    flagged = hits.select("k", F.explode(F.array_distinct("h")).alias("h")).join(_repeated(hits, "h"), "h")
    flagged = written(flagged, "flagged")

    def second(key: bytes, copies: int, n: int, at: list, anchor: list, start: list, coarse: list, found: list) -> Iterator[tuple]:
        found, anchor = _unsigned(found), _unsigned(anchor)
        sure = np.unique(np.array(start)[np.isin(_unsigned(coarse), found)]) if copies == 1 else np.arange(n - window + 1)
        done = covered(sure, window, n)
        more = open_anchors(np.array(at), anchor, np.isin(anchor, found), done, window)
        yield key, copies, n, int(done.sum()), sure.astype(np.int32) if copies == 1 else np.empty(0, np.int32), _signed(more)

    marked = classes.join(flagged.groupBy("k").agg(F.collect_list("h").alias("found")), "k").select("k", "copies", "n", "at", "anchor", "start", "coarse", "found")
    spans = written(marked.mapInArrow(_each(second, ["k", "copies", "n", "done", "sure", "open"]), "k binary, copies long, n long, done long, sure array<int>, open array<long>"), "spans")

    # Extension: all texts that hold an open anchor give the windows around it.
    asked = spans.select(F.explode("open").alias("h")).distinct()
    holders = flagged.join(asked, "h").groupBy("k").agg(F.collect_list("h").alias("open"))
    texts = source.groupBy("k").agg(F.first("t").alias("t")).join(holders, "k").join(spans.select("k", "copies", "sure"), "k")

    def third(key: bytes, copies: int, text: bytes, sure: list, asked: list) -> Iterator[tuple]:
        h = hashes(text.split())
        at, anchor = anchors(h, window)
        at = at[np.isin(anchor, _unsigned(asked))]
        near = np.flatnonzero(covered(np.maximum(at + GRAM - window, 0), window - GRAM + 1, len(h)) & _within(at, len(h), window))
        value, count = np.unique(runs_of(h, window)[near[near <= len(h) - window]], return_counts=True)
        yield key, copies, text, np.array(sure, np.int32), _signed(np.concatenate((value, value[count > 1])))

    extended = texts.select("k", "copies", "t", "sure", "open").mapInArrow(_each(third, ["k", "copies", "t", "sure", "wins"]), "k binary, copies long, t binary, sure array<int>, wins array<long>")
    extended = written(extended, "extended")
    again = extended.select("k", F.explode(F.array_distinct("wins")).alias("h")).join(_repeated(extended, "wins"), "h")
    ends = again.groupBy("k").agg(F.collect_list("h").alias("ends"))

    def fourth(key: bytes, text: bytes, sure: list, ends: list | None) -> Iterator[tuple]:
        words = text.split()
        gone = covered(np.array(sure, np.int64), window, len(words))
        if ends:
            gone |= covered(np.flatnonzero(np.isin(runs_of(hashes(words), window), _unsigned(ends))), window, len(words))
        kept = b" ".join([w for w, x in zip(words, gone.tolist(), strict=True) if not x])
        yield key, int(gone.sum()), kept, hashlib.sha256(kept).hexdigest()

    partly = extended.where("copies = 1").select("k", "t", "sure").join(ends, "k", "left")
    partly = partly.mapInArrow(_each(fourth, ["k", "gone", "kept", "kept_sha"]), "k binary, gone long, kept binary, kept_sha string")
    whole = spans.where("done = n").select("k", F.col("n").alias("all_gone"))
    out = classes.select("k", "n", "sha").join(partly, "k", "left").join(whole, "k", "left")
    removed = F.coalesce("all_gone", "gone", F.lit(0).cast("long"))
    sha = F.when(F.col("all_gone").isNotNull(), F.lit(_NO_WORDS)).otherwise(F.coalesce("kept_sha", "sha"))
    kept = F.when(F.col("all_gone").isNotNull(), F.lit("").cast("binary")).when(F.col("gone") > 0, F.col("kept"))
    return out.select(F.col("k").alias("text_key"), F.col("n").alias("n_words"), removed.alias("n_removed"), kept.alias("kept"), sha.alias("kept_sha256"))


def _within(at: np.ndarray, n: int, window: int) -> np.ndarray:
    """Starts at or before an anchor of ``at`` such that the window holds all of it."""
    ok = np.zeros(n, bool)
    for back in range(window - GRAM + 1):
        start = at - back
        ok[start[start >= 0]] = True
    return ok


def text_key(text_col: str) -> F.Column:
    """The key of a text's class: its MD5, null as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def without_repeats(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", window: int = 35) -> DataFrame:
    """``docs`` with each text cut to its kept words, joined by one space; ``chars_col``, if there, counts its code points.

    Texts that lose no word stay as they are. Rows that lose all their words go; rows that had none stay.
    """
    found = repeats(docs, text_col, window).select(F.col("text_key").alias("_key"), F.col("kept").alias("_kept"), (F.col("n_removed") < F.col("n_words")).alias("_some"), "n_words")
    found = found.withColumnRenamed("n_words", "_n")
    out = docs.withColumn("_key", text_key(text_col)).join(found, "_key").where("_some or _n = 0")
    text = F.coalesce(F.col("_kept").cast("string"), F.col(text_col))
    out = out.withColumn(text_col, text)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col("_kept").isNotNull(), F.length(text_col)).otherwise(F.col(chars_col)).cast(docs.schema[chars_col].dataType))
    return out.select(*docs.columns)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """(id_col, n_words, n_removed, kept_sha256): one row per row of ``docs``, nulls and repeated rows too.

    A text shorter than a window loses nothing. Equal texts of at least a window lose all their words, as every window
    also starts in the other.
    """
    # Written, so that the join below has two plain sides, whose hot keys can be split.
    found = written(repeats(docs, text_col, window).select("text_key", "n_words", "n_removed", "kept_sha256"), "repeats")
    out = docs.select(F.col(id_col), text_key(text_col).alias("text_key")).join(found, "text_key")
    return out.select(id_col, "n_words", "n_removed", "kept_sha256")
