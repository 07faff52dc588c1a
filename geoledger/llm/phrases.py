"""Phrase collocations, counted in counting quotient filters.

The frequent words get numbers, and texts become runs of them. A phrase is its numbers packed into one integer of a fixed
width. An invertible permutation (the upper bits xor a hash of the lower ones) spreads it: the upper bits are the quotient,
the lower ones the full remainder, so that a filter of sorted (quotient, remainder, counter) is lossless. Each task counts
what it reads into such filters, cut by ranges of quotients; those of a range are merged over all tasks.

Phrases grow by a word a level. A phrase can only be frequent if those without its first and its last word are; a
bounded Bloom filter of the level before tells most that aren't. It only spares work: counts come from the filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.words import mixed
from geoledger.scratch import written

#: Words whose numbers each worker holds; those of rarer frequent words come by a join.
HEAD = 1 << 18
#: Bytes of text that are split at a time, numbers in a row of the encoded table, rows that are counted at a time, entries that a
#: worker counts before it sends them on.
STRETCH, ROW, STEP, ENTRIES = 1 << 20, 2048, 64, 1 << 19
#: Texts that a worker takes apart at a time.
TEXTS = 1000
#: Occurrences for each range of quotients: the most entries that one task merges.
MERGED = 1 << 22
#: Bits of the Bloom filter at most, bits for each phrase in it, and places that a phrase sets.
BLOOM_BITS, BLOOM_SHARE, BLOOM_PLACES = 1 << 27, 16, 3
#: Packed phrases have at most so many bits.
WIDTH = 128

# 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def words_of(texts: list[bytes]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, which of them begin a piece) of stretches of the texts; a stretch ends where a piece does."""
    data, at = np.frombuffer(b"\n".join(texts), np.uint8), 0
    while at < len(data):
        end = min(at + STRETCH, len(data))
        while end < len(data):
            ahead = np.flatnonzero(_KIND[data[end : end + 65536]] == 2)
            end += int(ahead[0]) + 1 if len(ahead) else 65536
            if len(ahead):
                break
        part = data[at:end]
        at = end
        kind = _KIND[part]
        word = np.concatenate(([False], kind == 0, [False]))
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, length = edge[::2], edge[1::2] - edge[::2]
        piece = np.searchsorted(np.flatnonzero(kind == 2), start)
        offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[part[word[1:-1]]])]
        yield pa.Array.from_buffers(pa.binary(), len(start), buffers), np.diff(piece, prepend=-1) > 0


def _by_lang(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a batch of (text, lang) by language, of TEXTS rows at a time."""
    for a in range(0, b.num_rows, TEXTS):
        part = b.slice(a, TEXTS)
        langs = part.column(1).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, part.column(0).filter(pc.equal(langs.indices, k)).drop_null().to_pylist()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by(["lang", "w"]).aggregate([("n", "sum")]).rename_columns(["lang", "w", "n"])

    for b in batches:
        for lang, texts in _by_lang(b):
            for words, _ in words_of(texts):
                counts = words.value_counts()
                held.append(pa.table({"lang": pa.array([lang] * len(counts), pa.string()), "w": counts.field(0), "n": counts.field(1)}))
                rows += len(counts)
                if rows > ENTRIES // 2:
                    held = [summed()]
                    rows = held[0].num_rows
                    if rows > ENTRIES // 4:
                        yield from held.pop().to_batches()
                        rows = 0
    if held:
        yield from summed().to_batches()


def _encoder(head: pa.Array, tail: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (text, lang) to rows of (lang, ids, rest): 0 parts runs of numbered words; -k stands for the k-th word of ``rest``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in _by_lang(b):
                for words, begins in words_of(texts):
                    coded = words.dictionary_encode()
                    known = pc.fill_null(pc.index_in(coded.dictionary, value_set=head), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                    index = coded.indices.to_numpy(zero_copy_only=False)
                    if tail:
                        known[known == 0] = -1
                    ids = np.insert(known[index], np.flatnonzero(begins), 0)
                    place = np.insert(index, np.flatnonzero(begins), -1)
                    # Zeros one after another say no more than one, and a word alone makes no phrase.
                    full = ids != 0
                    near = np.concatenate((full[1:], [False])) | np.concatenate(([False], full[:-1]))
                    ids = np.where(full & ~near, 0, ids)
                    used = (ids != 0) | (np.concatenate(([0], ids[:-1])) != 0)
                    ids, place = ids[used], place[used]
                    zeros = np.flatnonzero(ids == 0) + 1
                    cuts = np.unique(zeros[np.searchsorted(zeros, np.arange(ROW, len(ids), ROW)).clip(max=len(zeros) - 1)]) if len(zeros) else zeros
                    for part, where in zip(np.split(ids, cuts), np.split(place, cuts), strict=True):
                        if not part.any():
                            continue
                        unsaid, back = np.unique(where[part < 0], return_inverse=True)
                        part[part < 0] = -1 - back
                        rest = coded.dictionary.take(pa.array(unsaid, pa.int32())).to_pylist()
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.string()), "ids": pa.array([part.astype(np.int32)], pa.list_(pa.int32())), "rest": pa.array([rest], pa.list_(pa.binary()))})

    return encode


def _joined(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same rows in batches of up to 500."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in rows(batches):
            held.append(b)
            if len(held) == 500:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return each


def pack(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(quotients, remainders) of phrases, a column of numbers for each word."""
    total, low_bits = bits * len(columns), min(64, bits * (len(columns) - 1))
    if total > WIDTH:
        raise ValueError(f"phrases of {len(columns)} words of {bits} bits do not fit into {WIDTH} bits")
    u = np.uint64
    hi, lo = np.zeros(len(columns[0]), u), np.zeros(len(columns[0]), u)
    for c in columns:
        hi = (hi << u(bits)) | (lo >> u(64 - bits))
        lo = (lo << u(bits)) | c.astype(u)
    if low_bits < 64:
        hi, lo = (hi << u(64 - low_bits)) | (lo >> u(low_bits)), lo & u((1 << low_bits) - 1)
    return hi ^ (mixed(lo) & u((1 << (total - low_bits)) - 1)), lo


def unpack(quotient: np.ndarray, remainder: np.ndarray, words: int, bits: int) -> list[np.ndarray]:
    """The numbers behind quotients and remainders: the inverse of :func:`pack`."""
    total, low_bits = bits * words, min(64, bits * (words - 1))
    u, mask = np.uint64, np.uint64((1 << bits) - 1)
    hi, lo = quotient ^ (mixed(remainder) & u((1 << (total - low_bits)) - 1)), remainder
    if low_bits < 64:
        hi, lo = hi >> u(64 - low_bits), lo | (hi << u(low_bits))
    out = []
    for _ in range(words):
        out.append((lo & mask).astype(np.int64))
        hi, lo = hi >> u(bits), (lo >> u(bits)) | (hi << u(64 - bits))
    return out[::-1]


def tally(quotient: np.ndarray, remainder: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (quotient, remainder) with their counters summed; without ``counts`` each is one."""
    order = np.lexsort((remainder, quotient))
    q, r = quotient[order], remainder[order]
    first = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (r[1:] != r[:-1]))) if len(q) else np.empty(0, bool))
    total = np.diff(first, append=len(q)) if counts is None else np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return q[first], r[first], total.astype(np.int64)


def to_bytes(quotient: np.ndarray, remainder: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted filter as bytes: steps between quotients, remainders of as many bytes as they need, counters of one byte and the large ones after."""
    steps = np.diff(quotient, prepend=np.uint64(0))
    step_bytes = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    rest_bytes = max(1, (int(remainder.max(initial=0)).bit_length() + 7) // 8)
    large = counts >= 255
    head = np.array([len(quotient), step_bytes, rest_bytes], "<i8").tobytes()
    thin = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes() for x, n in ((steps, step_bytes), (remainder, rest_bytes))]
    return b"".join((head, *thin, np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()))


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of :func:`to_bytes`."""
    n, step_bytes, rest_bytes = np.frombuffer(data, "<i8", 3).tolist()
    at, out = 24, []
    for width in (step_bytes, rest_bytes):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        out.append(wide.reshape(-1).view("<u8"))
        at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(data, "<i8", int(large.sum()), at + n)
    return np.cumsum(out[0], dtype=np.uint64), out[1], counts


def _places(h: np.ndarray, size: int) -> list[np.ndarray]:
    step = (h >> np.uint64(33)) | np.uint64(1)
    return [(h + np.uint64(j) * step) & np.uint64(size - 1) for j in range(BLOOM_PLACES)]


def _runs(ids: np.ndarray, words: int) -> np.ndarray:
    """A hash of each ``words`` consecutive numbers."""
    n = max(0, len(ids) - words + 1)
    h = np.zeros(n, np.uint64)
    for j in range(words):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64))
    return h


def _bloom(phrases: DataFrame, words: int, n: int) -> tuple[np.ndarray, int]:
    """(words of bits, number of bits) of a Bloom filter of ``n`` phrases; never more than BLOOM_BITS."""
    size = min(BLOOM_BITS, 1 << max(6, (BLOOM_SHARE * n).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).flatten().to_numpy().reshape(-1, words)
            h = np.zeros(len(ids), np.uint64)
            for c in ids.T:
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
            at = np.concatenate(_places(h, size))
            yield pa.RecordBatch.from_pydict({"at": (at >> np.uint64(6)).astype(np.int64), "bit": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    found = phrases.select("ids").mapInArrow(bits, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(size >> 6, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return out, size


def _level(encoded: DataFrame, words: int, bits: int, ranges: int, least: int, before: tuple[np.ndarray, int] | None) -> DataFrame:
    """(lang, ids, a) of the phrases of ``words`` words that are found ``least`` times or more in a language."""
    quotient_bits = bits * words - min(64, bits * (words - 1))
    sc = encoded.sparkSession.sparkContext
    bloom = sc.broadcast(before) if before else None
    # The range of a quotient is read from its leading bits.
    shift = max(0, quotient_bits - max(0, (ranges - 1).bit_length()))

    def steps(b: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
        langs = b.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == k)
            for a in range(0, len(at), STEP):
                yield lang, b.column(1).take(pa.array(at[a : a + STEP]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        entries = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                q, r, c = tally(*[np.concatenate(x) for x in zip(*parts, strict=True)])
                part = (q >> np.uint64(shift)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(q)], strict=True):
                    if b > a:
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.string()), "part": pa.array([part[a]], pa.int64()), "filter": pa.array([to_bytes(q[a:b], r[a:b], c[a:b])], pa.binary())})

        for b in batches:
            for lang, rows in steps(b):
                # A 0 after each row keeps phrases within it.
                ends = np.cumsum(np.diff(rows.offsets.to_numpy()))
                ids = np.insert(rows.flatten().to_numpy(), ends, 0)
                n = max(0, len(ids) - words + 1)
                fine = np.ones(n, bool)
                for j in range(words):
                    fine &= ids[j : j + n] > 0
                if bloom is not None:
                    filled, size = bloom.value
                    at = np.flatnonzero(fine)
                    h = _runs(ids, words - 1)
                    for step in (0, 1):
                        for p in _places(h[at + step], size) if len(at) else []:
                            hit = (filled[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
                            fine[at[~hit]] = False
                at = np.flatnonzero(fine)
                if not len(at):
                    continue
                found = tally(*pack([ids[at + j] for j in range(words)], bits))
                held.setdefault(lang, []).append(found)
                entries += len(found[0])
                if entries > ENTRIES:
                    held = {g: [tally(*[np.concatenate(x) for x in zip(*parts, strict=True)])] for g, parts in held.items()}
                    entries = sum(len(p[0][0]) for p in held.values())
                    if entries > ENTRIES // 2:
                        yield from out()
                        held, entries = {}, 0
        yield from out()

    def merge(t: pa.Table) -> pa.Table:
        q, r, c = tally(*[np.concatenate(x) for x in zip(*[from_bytes(f) for f in t.column("filter").to_pylist()], strict=True)])
        often = c >= least
        ids = np.stack(unpack(q[often], r[often], words, bits), 1).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, words), pa.int32()), pa.array(ids.reshape(-1)))
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(ids), pa.string()), "ids": lists, "a": c[often]})

    filters = encoded.select("lang", "ids").mapInArrow(_joined(count), "lang string, part long, filter binary")
    return written(filters.groupBy("lang", "part").applyInArrow(merge, "lang string, ids array<int>, a long"), f"phrases-{words}")


def _numbered(frequent: DataFrame, total: int) -> tuple[pa.Array, DataFrame]:
    """(the words of the dictionary's head, (id, w) of all frequent words); ids are 1, 2, ... by count in the head, anyhow after it."""
    spark = frequent.sparkSession
    head = frequent.orderBy(F.desc("n"), "w").limit(HEAD).collect()
    words = pa.array([bytes(r["w"]) for r in head], pa.binary())
    numbers = spark.createDataFrame(pa.table({"id": pa.array(range(1, len(head) + 1), pa.int32()), "w": words}), "id int, w binary")
    if total > HEAD:
        n, w = head[-1]["n"], head[-1]["w"]
        beyond = frequent.where((F.col("n") < n) | (F.col("n") == n) & (F.col("w") > F.lit(bytes(w))))
        dealt = written(beyond.select("w", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")), "tail")
        start, rows = HEAD + 1, []
        for r in dealt.groupBy("p").count().orderBy("p").collect():
            rows.append((r["p"], start - (r["p"] << 33)))
            start += r["count"]
        starts = spark.createDataFrame(rows, "p int, start long")
        numbers = numbers.union(dealt.join(starts, "p").select((F.col("m") + F.col("start")).cast("int").alias("id"), "w"))
    return words, written(numbers, "numbers")


def _resolved(encoded: DataFrame, numbers: DataFrame) -> DataFrame:
    """The encoded rows with the numbers of frequent words of ``rest`` in their places, and 0 for the others."""
    rows = written(encoded.withColumn("row", F.monotonically_increasing_id()), "unresolved")
    asked = rows.select("row", F.posexplode("rest").alias("k", "w"))
    answers = asked.join(numbers, "w").groupBy("row").agg(F.collect_list("k").alias("at"), F.collect_list("id").alias("id"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ids, rest, at, id_ in zip(*[b.column(k).to_pylist() for k in range(1, 5)], strict=True):
                number = np.zeros(rest + 1, np.int64)
                if at:
                    number[np.array(at) + 1] = id_
                ids = np.array(ids)
                out.append(np.where(ids < 0, number[np.maximum(-ids, 0)], ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["lang", "ids"])

    both = rows.join(answers, "row", "left").select("lang", "ids", F.size("rest").alias("rest"), "at", "id")
    return both.mapInArrow(put, "lang string, ids array<int>")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100, share: int = 100) -> DataFrame:
    """(lang, ids, phrase, a, l, r, n, score) of the phrases of 2 to ``longest`` words that are found ``least`` times or more.

    Phrases inside a longer one that has at least ``share`` % of their count are left out. Pieces are what lies between
    ``.,;:!?`` and line ends. Null texts are empty, a null language is ``und``; texts needn't be UTF-8. Repeated rows count
    each; other columns don't matter. An empty table gives an empty result. Jobs run while the result is being built. There
    may be no more than 2^25 frequent words for phrases of five (WIDTH bits); beyond that a ValueError tells so.
    """
    texts = docs.select(F.col(text_col).cast("binary").alias("t"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("g"))
    counted = written(texts.mapInArrow(_count_words, "lang string, w binary, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")), "words")
    per_lang = written(counted.groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    often = counted.where(F.col("n") >= least)
    frequent = written(often.groupBy("w").agg(F.sum("n").alias("n")), "frequent")
    total, occurrences = frequent.count(), per_lang.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    head, numbers = _numbered(frequent, total)
    bits, ranges = max(1, total.bit_length()), 1 + occurrences // MERGED
    encoded = texts.mapInArrow(_joined(_encoder(head, total > HEAD)), "lang string, ids array<int>, rest array<binary>")
    encoded = written(_resolved(encoded, numbers) if total > HEAD else encoded.select("lang", "ids"), "runs")

    levels, before = [], None
    for words in range(2, longest + 1):
        levels.append(_level(encoded, words, bits, ranges, least, before))
        before = _bloom(levels[-1], words, levels[-1].count()) if words < longest else None
    candidates = levels[0]
    for level in levels[1:]:
        candidates = candidates.unionByName(level)

    # All parts of a candidate are frequent themselves, so that their counts are there.
    singles = often.join(numbers, "w").select("lang", F.array("id").alias("ids"), F.col("n").alias("a"))
    parts = singles.unionByName(candidates)
    cuts = candidates.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.slice("ids", 1, F.col("k")), "second": F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))})
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("second"), F.col("a").alias("r")), ["lang", "second"]).join(per_lang, "lang")
    score = F.expr("cast((cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)) * cast(1000 as decimal(4, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as bigint)")
    best = cuts.withColumn("score", score).groupBy("lang", "ids").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))

    longer = candidates.where(F.size("ids") > 2).select("lang", "ids", F.col("a").alias("b"), F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("size"))
    longer = longer.select("lang", "b", "ids", "size", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("size") + 1)).alias("at"))
    inside = longer.select("lang", F.slice("ids", F.col("at"), F.col("size")).alias("ids"), "b").groupBy("lang", "ids").agg(F.max("b").alias("b"))
    left = best.join(inside, ["lang", "ids"], "left").where(F.col("b").isNull() | (100 * F.col("b") < share * F.col("a")))

    spelled = left.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(numbers, "id").groupBy("lang", "ids")
    spelled = spelled.agg(F.array_sort(F.collect_list(F.struct("at", F.col("w").cast("string").alias("w")))).alias("ws"))
    phrase = F.array_join(F.transform("ws", lambda x: x["w"]), " ").alias("phrase")
    return left.join(spelled, ["lang", "ids"]).select("lang", "ids", phrase, "a", "cut.l", "cut.r", "n", "cut.score")


def best_phrases(docs: DataFrame, most: int = 2000, **options: object) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` collocations of each language, by score, then count, then phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, **options).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
