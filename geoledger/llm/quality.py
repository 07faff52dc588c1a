"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule looks at one measure of a text and votes good or bad, or abstains between its two bounds. How often each
rule votes each way on good and on bad texts is unknown, as is the share of good texts; both are estimated by
expectation-maximisation on the counts of vote patterns. With R rules there are at most 3**R patterns, whatever the
input, so that the counts are small enough for the driver. A text is kept if it is probably good given its votes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from geoledger.llm.words import covered, hashes, runs_of
from geoledger.scratch import written

_SYMBOLS = b"#*$%&|<>"
_SPACES = " \t\n\r\x0b\x0c"
_REPEAT_WINDOW = 8

# Very common words of the languages seen.
_COMMON = frozenset(
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they you were her she there been one all we"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei um noch wie einem über"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux ou si leur mais nous"
    " el los se del las por con para al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre ser también me hasta hay donde quien no su y".split()
)

#: (measure, good up to, bad from): higher is worse. Between the two the rule abstains.
RULES = (
    ("symbols a word", 0.02, 0.1),
    ("lone signs among words", 0.005, 0.1),
    ("capitals among letters", 0.15, 0.5),
    ("repeated words", 0.02, 0.3),
    ("repeated lines", 0.05, 0.5),
    ("most frequent word", 0.2, 0.4),
    ("marks in a row at the end of words", 0.005, 0.1),
    ("words equal to the one before", 0.02, 0.2),
    ("words found among the eight before", 0.35, 0.6),
    ("rarity of common words", 0.93, 0.985),
    ("distance of word length from 3 to 12", 0.0, 2.0),
    ("brevity: 1 by the number of words", 0.02, 0.05),
)
_ROW_OF_MARKS = re.compile(rb"[!?#*$%&]{2,}(?=[\s]|\Z)")


def base_counts(text: str) -> tuple[int, int, int, int, int, list[bytes], np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words with their hashes."""
    data = text.encode()
    words = data.split()
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(data.count(_SYMBOLS[i : i + 1]) for i in range(len(_SYMBOLS)))
    lines = Counter(x for x in data.split(b"\n") if x.split())
    repeated, h = 0, hashes(words)
    if len(words) > _REPEAT_WINDOW:
        _, at, n = np.unique(runs_of(h, _REPEAT_WINDOW), return_inverse=True, return_counts=True)
        repeated = int(covered(np.flatnonzero(n[at] > 1), _REPEAT_WINDOW, len(words)).sum())
    return len(words), chars, symbols, lines.total() - len(lines), repeated, words, h


def votes(text: str, counts: tuple) -> list[int]:
    """Each rule's vote: 1 good, 2 bad, 0 abstention. A text without words gets abstentions."""
    n, chars, symbols, dup_lines, repeated, words, h = counts
    if not n:
        return [0] * len(RULES)
    letters = sum(map(text.count, "aeinrstAEINRST"))
    capitals = sum(map(text.count, "AEINRST"))
    frequency = Counter(words)
    lone = sum(c for w, c in frequency.items() if len(w) <= 2 and not w.isalnum() and w.isascii())
    before = np.zeros(n, bool)
    same = int((h[1:] == h[:-1]).sum())
    for back in range(1, min(9, n)):
        before[back:] |= h[back:] == h[:-back]
    n_lines = sum(1 for x in text.split("\n") if x.split())
    common = sum(c for w, c in frequency.items() if w.decode(errors="replace").lower().strip(".,!") in _COMMON)
    length = chars / n
    values = (
        symbols / n, lone / n, capitals / max(1, letters), repeated / n, dup_lines / max(1, n_lines), max(frequency.values()) / max(10, n),
        len(_ROW_OF_MARKS.findall(text.encode())) / n, same / n, before.sum() / n, 1 - common / n, max(0.0, 3 - length, length - 12), 1 / n,
    )
    return [1 if v <= good else 2 if v >= bad else 0 for v, (_, good, bad) in zip(values, RULES, strict=True)]


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good texts, and how likely each rule's votes are (class bad or good, rule, abstain or good or bad), by EM.

    An abstention says nothing: it is as likely for good texts as for bad ones.

    It begins with the belief that each vote for bad makes a text less likely to be good. Votes are smoothed by one of
    each, so that no rule is ever certain.
    """
    one_hot = (patterns[:, :, None] == np.arange(3)).astype(float)
    good = np.clip(0.9 - 0.4 * one_hot[:, :, 2].sum(1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack((counts * (1 - good), counts * good))
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        table = np.einsum("cp,prv->crv", weight, one_hot) + 1
        table /= table[:, :, 1:].sum(2, keepdims=True)
        table[:, :, 0] = 1
        new = posterior(patterns, share, table)
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return share, table


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """Probability that a text with these votes is good."""
    rules = np.arange(patterns.shape[1])
    bad, good = (np.log(t[rules, patterns]).sum(1) for t in table)
    return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - share) / share), -500, 500)))


def _lean(votes: Column, share: float, table: np.ndarray) -> Column:
    """Log-odds that a text with these votes (a number with a digit of base 3 for each rule) is good."""
    out = F.lit(float(np.log(share / (1 - share))))
    for rule, weights in enumerate(np.log(table[1]) - np.log(table[0])):
        vote = F.pmod(F.floor(votes / 3**rule), F.lit(3)).cast("int")
        out = out + F.element_at(F.array(*[F.lit(float(w)) for w in weights]), vote + 1)
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 20, most_repeated: int = 30) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), one row per row of ``docs``.

    A null text is as an empty one: no words, which fails the base; bytes that are no UTF-8 are read as U+FFFD. All texts
    with a word take part in the estimation, those that fail the base too. Repeated rows each count. An empty table gives
    an empty result; other columns of ``docs`` don't matter.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kind = docs.schema[id_col]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                text = (text or b"").decode(errors="replace")
                counts = base_counts(text)
                rows.append((*counts[:5], counts[0] < least_words or 100 * counts[4] > most_repeated * counts[0], sum(v * 3**i for i, v in enumerate(votes(text, counts)))))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["id", *names, "base_failed", "votes"])

    schema = StructType([StructField("id", kind.dataType), *[StructField(n, LongType()) for n in names], StructField("base_failed", BooleanType()), StructField("votes", LongType())])
    voted = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary")).mapInArrow(each, schema), "votes")
    rows = voted.where("n_words > 0").groupBy("votes").count().collect()
    codes = np.array([r["votes"] for r in rows], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(RULES)) % 3
    share, table = accuracies(patterns, np.array([r["count"] for r in rows], float))
    kept = ~F.col("base_failed") & (_lean(F.col("votes"), share, table) >= 0)
    return voted.select(F.col("id").alias(id_col), *names, "base_failed", kept.alias("kept"))
