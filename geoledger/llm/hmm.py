"""A hidden Markov language model, trained with Baum-Welch, and scored by the scaled forward recursion.

The model emits classes: each of the most frequent words is one, each other word belongs to one by its ending. Within an
ending's class a word has its share of the class's training counts, plus one. So the tables that all executors need are
bounded whatever the vocabulary, and the likelihood of a text is exact: that of its classes by the recursion, times
its words' shares.

All training texts are counted. A few short rounds over shards of them find the states; then each Baum-Welch round reads all
training texts, until a round gains less than ``GAIN`` a token. A round's expected counts are summed within tasks and
then over tasks. Texts of a task are run together, step by step.

A word outside the bounded dictionary finds its count through a join, by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from geoledger.llm.toxicity import fold_of
from geoledger.llm.words import split
from geoledger.scratch import written

#: States; classes of single words and of endings; words whose counts every task knows (both bounds may be passed by some thousandths).
STATES, WORDS, ENDINGS, DICTIONARY = 8, 8192, 256, 200_000
#: Shards, and how many of them the first short rounds read, one each.
SHARDS, FIRST = 32, 8
#: Rounds over all training texts end when one gains less log10 likelihood a token; so many are made at most.
GAIN, MOST_ROUNDS = 0.0005, 30
#: Tokens run together, and smoothing by the unigram model (in tokens a state).
_TOGETHER, _SMOOTHING = 800_000, 20.0
_END = b"\n"
_FRACTIONS = 1 << 30


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(tokens without the ends, their number in each text): words with A-Z in lower case; null as empty."""
    return split(texts, lower=True)


def ending(word: bytes) -> int:
    """The class of endings that a word belongs to."""
    return xxhash.xxh64_intdigest(word[-3:], 42) % ENDINGS


def _ending(word: Column) -> Column:
    """The same in the JVM, whose hash is signed."""
    return F.pmod(F.xxhash64(F.substring(word, -3, 3)), F.lit(ENDINGS))


@dataclass
class Vocabulary:
    """The dictionary: words (single classes first, by falling count), logs of counts plus one, logs of each ending's total; tokens and types of the training texts.

    ``listed`` is true for the rows of the table of counts that the dictionary holds.
    """

    words: list[bytes]
    logs: np.ndarray
    ending_logs: np.ndarray
    n_tokens: int
    n_types: int
    singles: int
    listed: Column


def _counts(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int) -> DataFrame:
    """(w, c): counts of the tokens of all training texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                seen = pc.value_counts(_words(b.column(0))[0])
                words, n = seen.field(0), seen.field(1)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([_END], pa.binary())]), pa.concat_arrays([n, pa.array([b.num_rows], pa.int64())])], names=["w", "c"])

    training = docs.where(fold_of(F.col(id_col), folds) != held).select(F.col(text_col).cast("binary"))
    return written(training.mapInArrow(each, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")), "counts")


def vocabulary(counts: DataFrame, dictionary: int | None = None, words: int | None = None) -> Vocabulary:
    """What every task gets to know of the counts: about ``dictionary`` words at most, and the endings' totals.

    Words are taken by falling count. Of those of about equal count that don't all fit, a part chosen by a hash is taken.
    """
    dictionary, words = dictionary or DICTIONARY, words or WORDS
    size = F.floor(F.log2("c") * 64).cast("int")  # at most 64 steps a doubling: some thousands
    steps = sorted(((r["s"], r["n"], r["c"]) for r in counts.groupBy(size.alias("s")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()), reverse=True)

    def top(most: int) -> Column:
        total = 0
        for s, n, _ in steps:
            if total + n > most:
                part = F.pmod(F.xxhash64("w", F.lit(9)), F.lit(_FRACTIONS)) < int(_FRACTIONS * (most - total) / n)
                return (size > s) | (size == s) & part
            total += n
        return F.lit(True)

    listed, single = top(dictionary), top(min(words, dictionary) - 1)
    rows = counts.where(listed).select("w", "c", single.alias("single")).collect()
    rows.sort(key=lambda r: (not r["single"], -r["c"], r["w"]))
    totals = np.ones(ENDINGS)
    for r in counts.where(~single).groupBy(_ending(F.col("w")).alias("e")).agg(F.sum(F.col("c") + 1).alias("n")).collect():
        totals[r["e"]] += r["n"]
    logs = np.log10(np.array([r["c"] for r in rows], float) + 1)
    return Vocabulary([bytes(r["w"]) for r in rows], logs, np.log10(totals), sum(c for _, _, c in steps), sum(n for _, n, _ in steps), sum(r["single"] for r in rows), listed)


def _encoded(docs: DataFrame, voc: Vocabulary, id_col: str, text_col: str, folds: int, held: int) -> DataFrame:
    """Each row's classes as 16-bit numbers, what is known of its words' counts, and hashes of the words that the dictionary lacks."""
    listed, logs, ending_logs, singles = voc.words, voc.logs, voc.ending_logs, voc.singles

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = len(listed), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        index = pa.array([*listed], pa.binary())
        # By place in the dictionary, and for words that it lacks: log of the count plus one, class, log of the share in the class.
        count = np.concatenate((logs, [0.0]))
        endings = np.fromiter(map(ending, listed[singles:]), np.int64, known - singles)
        of = np.concatenate((np.arange(singles), singles + endings, [0]))
        share = np.concatenate((np.zeros(singles), logs[singles:] - ending_logs[endings], [0.0]))
        end = listed.index(_END) if _END in listed else known
        for b in batches:
            words, length = _words(b.column(2))
            stop = np.cumsum(length + 1) - 1
            at = np.full(int(length.sum()) + len(length), end, np.int64)
            inside = np.ones(len(at), bool)
            inside[stop] = False
            at[inside] = pc.fill_null(pc.index_in(words, value_set=index), known).to_numpy()
            classes, shares = of[at].astype(np.int16), share[at]
            row = np.repeat(np.arange(len(length)), length + 1)
            lacking = np.flatnonzero(at == known)
            # The end itself may be lacking, if there are no training texts.
            coded = pa.concat_arrays([words, pa.array([_END], pa.binary())]).take(pa.array(np.where(inside, np.cumsum(inside) - 1, len(words))[lacking])).dictionary_encode()
            kinds, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            kind_of = np.fromiter(map(ending, kinds), np.int64, len(kinds))
            hashed = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in kinds), np.uint64, len(kinds)).view(np.int64)
            if len(lacking):
                classes[lacking] = singles + kind_of[code]
                shares[lacking] = -ending_logs[kind_of[code]]
            pairs, times = np.unique(row[lacking] * max(1, len(kinds)) + code, return_counts=True)
            rare_row, rare_code = np.divmod(pairs, max(1, len(kinds)))
            rare_at = pa.array(np.concatenate(([0], np.cumsum(np.bincount(rare_row, minlength=len(length))))).astype(np.int32))
            begins = stop - length
            n_known, log_counts, log_shares = (np.add.reduceat(x, begins) if len(begins) else np.zeros(0) for x in ((at < known).astype(np.int64), count[at], shares))
            bounds = pa.array((np.concatenate(([0], np.cumsum(length + 1))) * 2).astype(np.int32))
            arrays = [
                pa.array(n + 1 + np.arange(len(length))), pa.array(length + 1), pa.array(n_known, pa.int64()), pa.array(log_counts, pa.float64()), pa.array(log_shares, pa.float64()),
                pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, bounds.buffers()[1], pa.py_buffer(classes.tobytes())]),
                pa.ListArray.from_arrays(rare_at, pa.array(hashed[rare_code])), pa.ListArray.from_arrays(rare_at, pa.array(times.astype(np.int32))),
            ]
            n += len(length)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), *arrays], names=["id", "held_out", "shard", "uid", "n_tokens", "n_known", "log_counts", "log_shares", "classes", "rare", "rare_n"])

    schema = StructType([
        StructField("id", docs.schema[id_col].dataType), StructField("held_out", BooleanType()), StructField("shard", IntegerType()), StructField("uid", LongType()),
        StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("log_counts", DoubleType()), StructField("log_shares", DoubleType()),
        StructField("classes", BinaryType()), StructField("rare", ArrayType(LongType())), StructField("rare_n", ArrayType(IntegerType())),
    ])
    shard = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.length(F.col(text_col).cast("binary"))), F.lit(SHARDS)).cast("int")
    source = docs.select(F.col(id_col).alias("id"), (fold_of(F.col(id_col), folds) == held).alias("held_out"), F.col(text_col).cast("binary").alias("t"), shard.alias("shard"))
    return written(source.mapInArrow(each, schema), "encoded")


@dataclass
class Model:
    """Start (K), transitions (K, K), emissions (classes, K); log10 likelihood a token of the training texts before each full round."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray
    history: list[float] = field(default_factory=list)


def _together(lists: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of sequences: (their places, classes step by step, number of sequences at each step); longest first in a step."""
    order = sorted(range(len(lists)), key=lambda i: -len(lists[i]))
    at = 0
    while at < len(order):
        to, total = at, 0
        while to < len(order) and (to == at or total + len(lists[order[to]]) <= _TOGETHER):
            total += len(lists[order[to]])
            to += 1
        part = order[at:to]
        at = to
        length = np.array([len(lists[i]) for i in part])
        alive = len(part) - np.searchsorted(np.sort(length), np.arange(length[0]), "right")
        before = np.cumsum(alive) - alive
        flat = np.empty(total, np.int64)
        for rank, i in enumerate(part):
            flat[before[: len(lists[i])] + rank] = lists[i]
        yield np.array(part), flat, alive


def forward(model: Model, flat: np.ndarray, alive: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(log10 likelihood of each sequence, scale of each step); ``kept`` takes the scaled forward values."""
    emitted = model.emits[flat]
    score, scales = np.zeros(alive[0] if len(alive) else 0), np.empty(len(flat), emitted.dtype)
    at, now = 0, None
    for n in alive.tolist():
        now = emitted[at : at + n] * (model.start if now is None else now[:n] @ model.moves)
        scale = now.sum(1)
        now /= scale[:, None]
        score[:n] += np.log10(scale)
        scales[at : at + n] = scale
        if kept is not None:
            kept[at : at + n] = now
        at += n
    return score, scales


def expected(model: Model, flat: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (start, moves, emits) given the sequences, and their log10 likelihood."""
    ahead = np.empty((len(flat), len(model.start)), model.emits.dtype)
    score, scales = forward(model, flat, alive, ahead)
    emitted = model.emits[flat]
    moves = np.zeros_like(model.moves, dtype=float)
    behind = np.ones((0, len(model.start)), model.emits.dtype)
    begins = (np.cumsum(alive) - alive).tolist()
    for step in range(len(alive) - 1, -1, -1):
        at, n = begins[step], int(alive[step])
        # Sequences that end at this step have nothing behind them.
        behind = np.concatenate((behind, np.ones((n - len(behind), behind.shape[1]), behind.dtype)))
        now = ahead[at : at + n]
        if at:
            into = emitted[at : at + n] * behind / scales[at : at + n, None]
            one_earlier = begins[step - 1]
            moves += ahead[one_earlier : one_earlier + n].T @ into
            back = into @ model.moves.T
        now *= behind
        if at:
            behind = back
    ahead /= ahead.sum(1, keepdims=True)
    emits = np.stack([np.bincount(flat, ahead[:, k], len(model.emits)) for k in range(ahead.shape[1])], 1)
    return ahead[: alive[0]].sum(0), moves * model.moves, emits, float(score.sum())


def _round(encoded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts over the rows of ``encoded``: summed in each task, then over all."""
    k, n = len(model.start), len(model.emits)
    small = Model(*(x.astype(np.float32) for x in (model.start, model.moves, model.emits)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + k + 2, k))
        for b in batches:
            for _, flat, alive in _together([np.frombuffer(c, np.int16) for c in b.column(0).to_pylist()]):
                start, moves, emits, score = expected(small, flat, alive)
                total[:n] += emits
                total[n : n + k] += moves
                total[n + k] += start
                total[n + k + 1, 0] += score
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, j]) for j in range(k)]], names=["row", *[f"s{j}" for j in range(k)]])

    found = encoded.select("classes").mapInArrow(each, "row long, " + ", ".join(f"s{j} double" for j in range(k)))
    total = np.zeros((n + k + 2, k))
    for r in found.groupBy("row").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)]).collect():
        total[r["row"]] = r[1:]
    return total[n + k], total[n : n + k], total[:n], total[n + k + 1, 0]


def _next(expected_counts: tuple, common: np.ndarray, states: int, history: list[float]) -> Model:
    """The model of the expected counts, smoothed."""
    start, moves, emits = expected_counts
    moves = moves + 1.0 / states + 2.0 * np.eye(states)
    emits = emits + _SMOOTHING * common[:, None]
    return Model((start + 1) / (start + 1).sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0), history)


def train(encoded: DataFrame, voc: Vocabulary, states: int = STATES, seed: int = 3, gain: float = GAIN, most_rounds: int = MOST_ROUNDS) -> Model:
    """Baum-Welch over the training rows of ``encoded``; deterministic but for the order of sums."""
    n = voc.singles + ENDINGS
    common = np.concatenate((10.0 ** voc.logs[: voc.singles], 10.0**voc.ending_logs))
    common = common / common.sum()
    rng = np.random.default_rng(seed)
    emits = common[:, None] * rng.gamma(0.3, size=(n, states)) + 0.05 * common[:, None]
    model = Model(np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emits / emits.sum(0))
    if not voc.n_tokens:
        return model
    training = encoded.where("not held_out")
    for shard in range(FIRST):
        *found, _ = _round(training.where(F.col("shard") == shard), model)
        if found[2].sum():
            model = _next(tuple(found), common, states, [])
    history: list[float] = []
    for _ in range(most_rounds):
        *found, score = _round(training, model)
        history.append(score / voc.n_tokens)
        model = _next(tuple(found), common, states, history)
        if len(history) > 1 and history[-1] - history[-2] < gain:
            break
    return model


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, dictionary: int | None = None, words: int | None = None) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Null texts are as empty ones: the end alone. Texts are taken as bytes, valid UTF-8 or not. Repeated rows each count and are
    scored each; null ids are training rows. An empty table gives an empty result; without training rows every word has
    the same share. Other columns of ``docs`` don't matter. ``dictionary`` and ``words`` bound what every task knows;
    n_known and base_score don't depend on them.
    """
    counts = _counts(docs, id_col, text_col, folds, held)
    voc = vocabulary(counts, dictionary, words)
    encoded = _encoded(docs, voc, id_col, text_col, folds, held)
    model = train(encoded, voc)
    rest = ["uid", "id", "held_out", "n_tokens", "n_known", "log_counts", "log_shares"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [np.frombuffer(c, np.int16) for c in b.column(0).to_pylist()]
            out = np.zeros(len(lists))
            for part, flat, alive in _together(lists):
                out[part] = forward(model, flat, alive)[0]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(out)], names=[*rest, "chain"])

    schema = StructType([*[encoded.schema[c] for c in rest], StructField("chain", DoubleType())])
    chain = encoded.select("classes", *rest).mapInArrow(each, schema)
    pairs = encoded.where(F.size("rare") > 0).select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("uid", F.col("x.rare").alias("h"), F.col("x.rare_n").alias("n"))
    hashed = counts.where(~voc.listed).select(F.xxhash64("w").alias("h"), "c").groupBy("h").agg(F.max("c").alias("c"))
    found = pairs.join(hashed, "h").groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"), F.sum("n").alias("known"))
    out = chain.join(found, "uid", "left")
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("known", F.lit(0))
    base = F.col("log_counts") + more - F.col("n_tokens") * math.log10(voc.n_tokens + voc.n_types + 1)
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + known).cast("long").alias("n_known"), F.lit(voc.n_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("chain") + F.col("log_shares") + more).alias("score"),
    )
