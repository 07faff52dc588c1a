"""SentencePiece segmentation, best and n-best, over the piece lattice; and decoding.

The lattice has an edge for each piece of the vocabulary that a text holds; a segmentation's score is the sum of its
pieces' scores in the model file. A forward Viterbi pass gives the best score up to each place. That is an exact heuristic
for an A-star search from the end backwards, which pops segmentations in order of their score.

No piece goes over the beginning of a run of spaces, nor, in most vocabularies, from a word of Latin letters to a sign: there the lattice
falls into independent stretches. The n best
of a text differ from its best in stretches with the smallest losses only: at most n - 1 stretches are searched.
Characters without a piece, and bytes that are no UTF-8, are spelled in bytes. Decoding gives back the exact bytes.

Merged vocabularies give a score of about -1e9 to pieces that no merge makes (lone spaces, and runs of them). Taken as it
is, one such piece would outweigh all the others of a text and leave nothing to tell its segmentations apart. So by default
it is read as one below the worst other score (``never``); with ``never=None`` the file's score holds.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from geoledger.llm.words import raw

_SPACE = "▁"
#: Stands for a literal U+2581 within the lattice; a lone surrogate is in no valid text.
_LITERAL = "\udfff"
#: A piece in bytes is so much worse than the worst piece; characters of the stretches of a generation that a worker keeps; rows worked on at once.
_BYTES_PENALTY, _KEPT, _ROWS = 10.0, 1_000_000, 1000
#: Stretches of more characters aren't kept, so that those kept stay small.
_LONG = 500
_NEVER, _NONE = -1e8, float("-inf")


class Segmenter:
    """The pieces of a model file, with their scores; those that mean "never merged" are so much below the worst (None: as they are)."""

    def __init__(self, model_file: str, never: float | None = 1.0):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        usual = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.pieces = {model.id_to_piece(i): (model.get_score(i), i) for i in usual}
        self.longest = max(map(len, self.pieces), default=1)
        worst = min((s for s, _ in self.pieces.values() if s > _NEVER), default=0.0)
        if never is not None:
            self.pieces = {p: (s if s > _NEVER else worst - never, i) for p, (s, i) in self.pieces.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # A trie of the pieces: character -> [characters that follow, score or None, id].
        self.trie: dict[str, list] = {}
        for piece, (score, i) in self.pieces.items():
            level = self.trie
            for c in piece[:-1]:
                level = level.setdefault(c, [{}, None, 0])[0]
            level.setdefault(piece[-1], [{}, None, 0])[1:] = [score, i]
        self.spelled = worst - _BYTES_PENALTY
        self.text_of: dict[int, bytes] = {i: p.replace(_SPACE, " ").encode() for p, (_, i) in self.pieces.items()} | {i: bytes([b]) for b, i in enumerate(self.bytes)}
        # Between characters that follow each other in no piece the lattice falls apart: around line ends, before spaces,
        # and, if the vocabulary keeps them apart, between words and signs.
        neighbours = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        apart = "".join(c for c in "\n\r\t" if not any(c in p for p in neighbours))
        letters = "A-Za-zÀ-ÖØ-öø-ɏ"
        letter = re.compile(f"[{letters}]")
        if any(_SPACE not in p and bool(letter.match(p[0])) != bool(letter.match(p[1])) for p in neighbours):
            runs = [f"{_SPACE}*[^{_SPACE}{apart}]+"]
        else:
            runs = [f"{_SPACE}*[{letters}]+", f"{_SPACE}*[^{letters}{_SPACE}{apart}]+"]
        self._stretch = re.compile("|".join([*runs, f"{_SPACE}+", *([f"[{apart}]"] if apart else [])]))
        self._room = _KEPT
        self._known: dict[str, tuple[bytes, float, float]] = {}
        self._older = self._known
        self._searched: dict[tuple[str, int], list[tuple[float, tuple[int, ...] | None]]] = {}

    def _spelling(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes[x] for x in (_SPACE if c == _LITERAL else c).encode(errors="surrogateescape"))

    def edges(self, s: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """By start: (end, score, ids) of each edge of the lattice."""
        return [self._from(s, a) for a in range(len(s))]

    def _from(self, s: str, a: int) -> list[tuple[int, float, tuple[int, ...]]]:
        here, level = [], self.trie
        for b in range(a, len(s)):
            node = level.get(s[b])
            if node is None:
                break
            if node[1] is not None:
                here.append((b + 1, node[1], (node[2],)))
            level = node[0]
        if not here or here[0][0] != a + 1:
            here.insert(0, (a + 1, self.spelled, self._spelling(s[a])))
        return here

    def _into(self, s: str, b: int) -> list[tuple[int, float, int]]:
        """(start, score, id) of each edge that ends at ``b``; the id of a character in bytes is -1."""
        out = [(a, *self.pieces[p]) for a in range(max(0, b - self.longest), b) if (p := s[a:b]) in self.pieces]
        if not out or out[-1][0] != b - 1:
            out.append((b - 1, self.spelled, -1))
        return out

    def _forward(self, s: str) -> list[float]:
        best = [_NONE] * (len(s) + 1)
        best[0] = 0.0
        for a in range(len(s)):
            base = best[a]
            for b, score, _ in self._from(s, a):
                if base + score > best[b]:
                    best[b] = base + score
        return best

    def nbest_of(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a stretch, by score; of equal ones first that searched further, so the first is ``best_of``'s.

        An entry of the queue links to the one it goes on from. Entries stand for different segmentations, and each one's
        priority is the score of its best; so no more entries are kept than segmentations are still due.
        """
        best, made = self._forward(s), 0
        queue: list[tuple] = [(-best[len(s)], len(s), 0, 0.0, None)]
        out: list[tuple[float, tuple[int, ...]]] = []
        while queue and len(out) < n:
            _, at, _, tail, link = queue.pop(0)
            if at == 0:
                ids: list[int] = []
                while link:
                    a, i, link = link
                    ids += (i,) if i >= 0 else self._spelling(s[a])
                out.append((tail, tuple(ids)))
                continue
            for a, score, i in self._into(s, at):
                made += 1
                queue.append((-(best[a] + tail + score), a, made, tail + score, (a, i, link)))
            queue.sort()
            del queue[n - len(out) :]
        return out

    def best_of(self, s: str) -> tuple[bytes, float, float]:
        """(ids as 32-bit numbers, score, loss of the second best) of a stretch; of equal ones that with the longer last pieces.

        The forward pass keeps the two best scores at each place.
        """
        n, trie, spelled = len(s), self.trie, (self.spelled, -1)
        best, second, back = [_NONE] * (n + 1), [_NONE] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for a in range(n):
            base, other, b = best[a], second[a], a
            node = trie.get(s[a])
            if node is None or node[1] is None:
                node = [{} if node is None else node[0], *spelled]
            while True:
                b += 1
                score = node[1]
                if score is not None:
                    x = base + score
                    if x > best[b]:
                        y = other + score
                        second[b] = best[b] if best[b] > y else y
                        best[b] = x
                        back[b] = (a, node[2])
                    elif x > second[b]:
                        second[b] = x
                if b == n:
                    break
                node = node[0].get(s[b])
                if node is None:
                    break
        ids, at = [], n
        while at:
            a, i = back[at]
            ids += (i,) if i >= 0 else self._spelling(s[a])[::-1]
            at = a
        return array("i", ids[::-1]).tobytes(), best[n], best[n] - second[n]

    def _best(self, s: str) -> tuple[bytes, float, float]:
        found = self._older.get(s) or self.best_of(s)
        if len(s) <= _LONG:
            self._known[s] = found
            self._room -= len(s)
        return found

    def _tidy(self) -> None:
        """Between texts: of the stretches kept, those of the last two generations stay."""
        if self._room <= 0:
            self._known, self._older, self._searched, self._room = {}, self._known, {}, _KEPT

    def stretches(self, text: str) -> list[str]:
        if not text:
            return []
        return self._stretch.findall(_SPACE + text.replace(_SPACE, _LITERAL).replace(" ", _SPACE))

    def packed(self, text: str, n: int = 1) -> tuple[bytes, list[float]]:
        """(ids of the best segmentation as 32-bit numbers, scores of the n best)."""
        self._tidy()
        known, stretches = self._known, self.stretches(text)
        found = [known.get(s) or self._best(s) for s in stretches]
        score = float(sum([f[1] for f in found]))
        return b"".join([f[0] for f in found]), [score, *[score - x for x, _ in self._worse(stretches, [f[2] for f in found], n)]]

    def encode(self, text: str, n: int = 1) -> tuple[list[int], list[float]]:
        """The same with the ids as a list."""
        ids, scores = self.packed(text, n)
        return _unpacked(ids), scores

    def _worse(self, stretches: list[str], losses: list[float], n: int) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """(loss, ids by stretch that differ from the best) of the second to n-th best, by loss."""
        if n < 2 or not losses:
            return []
        loss, at, options = np.array(losses), [], []
        while len(at) < n - 1 and math.isfinite(loss[k := int(loss.argmin())]):
            at.append(k)
            loss[k] = math.inf
            options.append(self._options(stretches[k], n))
        # At most n options of n - 1 stretches: taken stretch by stretch, with the n best so far.
        so_far: list[tuple[float, dict[int, tuple[int, ...]]]] = [(0.0, {})]
        for k, choices in zip(at, options, strict=True):
            both = [(a + x, d if ids is None else d | {k: ids}) for (a, d), (x, ids) in product(so_far, choices)]
            so_far = sorted(both, key=lambda o: o[0])[:n]
        return so_far[1:]

    def _options(self, s: str, n: int) -> list[tuple[float, tuple[int, ...] | None]]:
        """(loss, ids) of the n best of a stretch; None stands for the best's ids."""
        found = self._searched.get((s, n))
        if found is None:
            best, *others = self.nbest_of(s, n)
            found = [(0.0, None), *[(best[0] - x, ids) for x, ids in others]]
            if len(s) <= _LONG:
                self._searched[s, n] = found
                self._room -= len(s) * n
        return found

    def nbest(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text with their ids."""
        stretches = self.stretches(text)
        found = [self._known.get(s) or self._best(s) for s in stretches]
        score = sum(f[1] for f in found)
        out = [(score, [i for f in found for i in _unpacked(f[0])])]
        for loss, other in self._worse(stretches, [f[2] for f in found], n):
            out.append((score - loss, [i for k, f in enumerate(found) for i in (other[k] if k in other else _unpacked(f[0]))]))
        return out

    def spelled_by(self, ids: list[int]) -> bytes:
        """The bytes that the ids spell; the space put before each text is taken off."""
        return b"".join(map(self.text_of.__getitem__, ids))[1:]

    def decode(self, ids: list[int]) -> str:
        """The same as text; bytes that are no UTF-8 as U+FFFD."""
        return self.spelled_by(ids).decode(errors="replace")


def _unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, np.int32).tolist()


@lru_cache(maxsize=4)
def segmenter(model_file: str, never: float | None = 1.0) -> Segmenter:
    """One per worker and file."""
    return Segmenter(model_file, never)


def _shipped(spark: SparkSession, model_file: str) -> str:
    """Sends the file to all workers and returns the name under which they find it."""
    spark.sparkContext.addFile(model_file)
    return model_file.rstrip("/").rpartition("/")[2]


def encode(docs: DataFrame, model_file: str, text_col: str = "text", nbest: int = 3, keep: tuple[str, ...] = ("doc_id",), never: float | None = 1.0) -> DataFrame:
    """Columns ``keep`` with ids, n_pieces, score, nbest_scores and decoded_ok, whether decoding gives back the text.

    A null text gives null ids and scores, no pieces, and is decoded_ok; an empty one has no ids and score 0. A text with
    fewer segmentations than ``nbest`` has fewer scores. Rows stay as they are, repeated ones too; an empty table gives an
    empty result. The model file is the driver's; it is sent to the workers.
    """
    name = _shipped(docs.sparkSession, model_file)
    kept = [f for f in docs.schema if f.name in keep]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(SparkFiles.get(name), never)
        for b in (whole.slice(k, _ROWS) for whole in batches for k in range(0, max(1, whole.num_rows), _ROWS)):
            texts = b.column(0).to_pylist()
            done = [(None, None) if t is None else s.packed(t.decode(errors="surrogateescape"), nbest) for t in texts]
            n = np.array([len(i or b"") // 4 for i, _ in done], np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32), mask=np.array([i is None for i, _ in done] + [False]))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join([i or b"" for i, _ in done]), np.int32)))
            fine = [t is None or s.spelled_by(_unpacked(i)) == t for t, (i, _) in zip(texts, done, strict=True)]
            first = pa.array([x[0] if x else None for _, x in done], pa.float64())
            columns = [ids, pa.array(n), first, pa.array([x for _, x in done], pa.list_(pa.float64())), pa.array(fine, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *columns], names=[*[f.name for f in kept], "ids", "n_pieces", "score", "nbest_scores", "decoded_ok"])

    new = [("ids", ArrayType(IntegerType())), ("n_pieces", LongType()), ("score", DoubleType()), ("nbest_scores", ArrayType(DoubleType())), ("decoded_ok", BooleanType())]
    schema = StructType([*kept, *[StructField(n, t) for n, t in new]])
    return raw(docs, text_col, [f.name for f in kept]).mapInArrow(each, schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in place of them; null ids give null."""
    name = _shipped(encoded.sparkSession, model_file)
    rest = [f for f in encoded.schema if f.name not in (ids_col, text_col)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(SparkFiles.get(name))
        for b in batches:
            texts = [None if i is None else s.decode(i) for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], names=[*[f.name for f in rest], text_col])

    from pyspark.sql.types import StringType

    return encoded.select(F.col(ids_col), *[F.col(f.name) for f in rest]).mapInArrow(each, StructType([*rest, StructField(text_col, StringType())]))
