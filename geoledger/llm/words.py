"""Words as the contracts of this subpackage take them, and 64-bit hashes of word sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words as a Java or RE2 pattern. ``bytes.split()`` splits at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def raw(df: DataFrame, column: str, rest: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``column`` as bytes, and after it the columns ``rest``; its name is none of theirs."""
    name = "_"
    while name in rest:
        name += "_"
    return df.select(F.col(column).cast("binary").alias(name), *rest)


def split(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, number of words of each) of a binary array; null as empty, A-Z in lower case if asked.

    The bytes are split as they are, valid UTF-8 or not: only ASCII is looked at.
    """
    plain = pc.fill_null(texts, b"").view(pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    bounds = lists.offsets.to_numpy().astype(np.int64)
    before = np.concatenate(([0], np.cumsum(full)))
    bounds = before[bounds - bounds[0]] if len(bounds) else np.zeros(1, np.int64)
    return flat.view(pa.binary()).filter(pa.array(full)), np.diff(bounds)


def hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """XXH64 of each word."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(h: np.ndarray, length: int, multiplier: int = _MULTIPLIER) -> np.ndarray:
    """A hash of each ``length`` consecutive values, by doubling: logarithmic in ``length``. Empty if there are fewer."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, have, block, size = None, 0, h, 1
    left = length
    while left:
        if left & 1:
            part = block[have : have + n]
            total = part if total is None else total * np.uint64(pow(multiplier, size, 1 << 64)) + part
            have += size
        left >>= 1
        if left:
            block = block[: len(block) - size] * np.uint64(pow(multiplier, size, 1 << 64)) + block[size:]
            size *= 2
    return mixed(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values; empty if there are fewer."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    block, size = x, 1
    while size * 2 <= width:
        block = np.minimum(block[: len(block) - size], block[size:])
        size *= 2
    return np.minimum(block[:n], block[width - size : width - size + n])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches of ``width`` places at ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:n]) > 0
