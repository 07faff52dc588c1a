"""SimHash near-duplicates: a binary trie of all fingerprints joined with itself.

Pairs of trie nodes are walked together from the root. Each level adds the bits in which the two nodes differ, and a
pair is pruned as soon as it exceeds the error budget. Of fingerprints cut into parts, two that differ in at most ``budget``
bits differ in at most ``budget // parts`` bits of one part; so a trie is walked for each part, of the fingerprints turned
so that it comes first, with that tighter budget down to its end. It finds the same pairs and visits few of the nodes.

The upper levels are walked as a shuffle: a fingerprint goes to each pair of top nodes within the budget that it is part of.
Nodes are counted, and pairs with a node of too many fingerprints go down some levels more, again by shuffle.
Each pair of subtrees is then walked in one task. Pairs are not sent on: a task returns a spanning forest of what
it found, at most one edge a fingerprint, and connected components are taken by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from geoledger.llm.words import raw
from geoledger.operators.graph import connected_components
from geoledger.scratch import written

#: Fingerprints of a subtree at about which another level of the trie is taken by the shuffle.
SUBTREE = 8192
#: A node of so many is taken so many levels further down by another shuffle.
HEAVY, LEVELS = 4 * SUBTREE, 4
#: Pairs of leaves compared at once.
_BLOCK = 1 << 20


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles, repeats included; 0 if there is no word. Fewer words than a shingle make one."""
    words = text.lower().split() if text else []  # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """Columns ``keep`` and fp (long): one row per row of ``docs``; null texts have fingerprint 0."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in b.column(0).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp)], names=[*keep, "fp"])

    schema = StructType([*[docs.schema[c] for c in keep], StructField("fp", LongType(), False)])
    return raw(docs, text_col, keep).mapInArrow(each, schema)


class _Forest:
    """Union-find over array indices, fed with whole arrays of pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        p = self.parent
        r = p[i]
        while True:
            q = p[r]
            if (q == r).all():
                break
            r = q
        p[i] = r
        return r

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.roots(i), self.roots(j)
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if len(i):
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _children(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where each node's right child begins; a node is a range of the sorted ``keys`` that share ``depth`` bits."""
    bit = np.uint64(1 << (63 - depth))
    return np.searchsorted(keys, (keys[lo] & ~((bit << np.uint64(1)) - np.uint64(1) if depth else np.uint64(2**64 - 1))) | bit)


def trie_join(keys: np.ndarray, left: tuple[int, int], right: tuple[int, int], depth: int, differing: int, budget: int, forest: _Forest, part: int = 32, tight: int | None = None, small: int = 96) -> None:
    """Walk two nodes of the trie over the sorted distinct ``keys`` together, and join leaves within the budget.

    ``left`` and ``right`` are ranges of ``keys``, equal for a node with itself; ``differing`` bits of their common
    depth differ. Down to ``part`` bits the budget is ``tight`` (half of it). Pairs of at most ``small`` leaf pairs are
    compared at once, which is the same as walking them to the end.
    """
    tight = budget // 2 if tight is None else tight
    if left[0] >= left[1] or right[0] >= right[1]:
        return
    stack = [(np.array([[left[0], left[1], right[0], right[1], differing]], np.int64), depth)]
    while stack:
        nodes, d = stack.pop()
        if len(nodes) > 1 << 18:
            stack += [(nodes[: len(nodes) // 2], d), (nodes[len(nodes) // 2 :], d)]
            continue
        pairs = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        leaf = (pairs <= small) if d < 64 else np.ones(len(nodes), bool)
        _compare(keys, nodes[leaf], pairs[leaf], budget, part, tight, forest)
        nodes = nodes[~leaf]
        if not len(nodes):
            continue
        a0, a2, b0, b2, diff = nodes.T
        a1 = np.clip(_children(keys, a0, a2, d), a0, a2)
        b1 = np.clip(_children(keys, b0, b2, d), b0, b2)
        same = (a0 == b0) & (a2 == b2)
        kids = [np.stack(x, 1) for x in ((a0, a1, b0, b1, diff), (a1, a2, b1, b2, diff), (a0, a1, b1, b2, diff + 1))]
        kids.append(np.stack((a1, a2, b0, b1, diff + 1), 1)[~same])
        kids = np.concatenate(kids)
        most = tight if d + 1 <= part else budget
        kids = kids[(kids[:, 4] <= most) & (kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3])]
        if len(kids):
            stack.append((kids, d + 1))


def _compare(keys: np.ndarray, nodes: np.ndarray, pairs: np.ndarray, budget: int, first: int, tight: int, forest: _Forest) -> None:
    top = np.uint64(2**64 - 1) << np.uint64(64 - first)
    at = 0
    bounds = np.cumsum(pairs)
    while at < len(nodes):
        to = max(at + 1, int(np.searchsorted(bounds, (bounds[at - 1] if at else 0) + _BLOCK, "right")))
        part, n = nodes[at:to], pairs[at:to]
        at = to
        which = np.repeat(np.arange(len(part)), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + k // width, part[which, 2] + k % width
        x = keys[i] ^ keys[j]
        near = (np.bitwise_count(x) <= budget) & (np.bitwise_count(x & top) <= tight) & (i != j)
        forest.join(i[near], j[near])


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def _turned(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _node(depth: int) -> Column:
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def _dealt(rows: DataFrame, depth: int, levels: int, limit: int, nodes: DataFrame | None = None) -> DataFrame:
    """(turn, key, lo, hi) ``levels`` further down: each key for all pairs of nodes within ``limit`` bits that it is part of.

    If ``nodes`` (turn, node) are given, for those only whose other node is one of them.
    """
    own = _node(depth + levels)
    # The node on the other side: above, that of the pair which doesn't hold the key.
    across = F.when(F.shiftrightunsigned(own, levels) == F.col("lo"), F.col("hi")).otherwise(F.col("lo")) if depth else F.lit(0).cast("long")
    left = F.lit(limit) - F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) if depth else F.lit(limit)
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(levels, limit)])
    near = rows.select("turn", "key", own.alias("own"), across.alias("across"), F.explode(F.filter(masks, lambda m: F.bit_count(m) <= left)).alias("mask"))
    low = F.col("own").bitwiseAND(F.lit((1 << levels) - 1).cast("long")).bitwiseXOR(F.col("mask"))
    other = F.shiftleft("across", levels).bitwiseOR(low)
    if nodes is not None:
        near = near.withColumn("node", other).join(nodes, ["turn", "node"], "left_semi")
    return near.select("turn", "key", F.least("own", other).alias("lo"), F.greatest("own", other).alias("hi"))


def near_links(fps: DataFrame, budget: int = 4, subtree: int = SUBTREE, heavy: int = HEAVY) -> DataFrame:
    """(a, b): edges of a spanning forest of the graph that links distinct ``fp`` values differing in at most ``budget`` bits.

    An edge of the forest joins two members of one component, which need not be within the budget themselves.
    """
    n = max(1, fps.count())
    bits = max(0, (n // subtree).bit_length())
    # Parts that are still longer than the trie is deep; each part's beginning.
    parts = 3 if n < 1 << 21 else 2
    begins = [64 * k // parts for k in range(parts + 1)]
    turned = [fps.select(F.lit(k).alias("turn"), _turned(F.col("fp"), begins[k]).alias("key")) for k in range(parts)]
    turned = reduce(DataFrame.unionByName, turned)
    width, tight = min(b - a for a, b in pairwise(begins)), budget // parts
    rows = turned.withColumns({"lo": F.lit(0).cast("long"), "hi": F.lit(0).cast("long")})
    if bits:
        rows = _dealt(rows, 0, bits, tight)
    done, depth = [], bits
    nodes = turned.groupBy("turn", _node(depth).alias("node")).count()
    while depth + LEVELS < 64:
        full = written(nodes.where(F.col("count") > heavy).select("turn", "node"), "heavy")  # at most one in ``heavy`` keys
        if full.isEmpty():
            break
        for side in ("lo", "hi"):
            rows = rows.join(full.select("turn", F.col("node").alias(side), F.lit(True).alias(f"full_{side}")), ["turn", side], "left")
        split = F.coalesce("full_lo", "full_hi", F.lit(False))
        rows = written(rows.select("turn", "key", "lo", "hi", split.alias("split")), "dealt")
        done.append(rows.where("not split").withColumn("depth", F.lit(depth)).drop("split"))
        rows = rows.where("split").drop("split")
        nodes = written(rows.select("turn", "key").distinct().groupBy("turn", _node(depth + LEVELS).alias("node")).count(), "nodes")
        rows = _dealt(rows, depth, LEVELS, tight if depth + LEVELS <= width else budget, nodes)
        depth += LEVELS
    done.append(rows.withColumn("depth", F.lit(depth)))
    dealt = reduce(DataFrame.unionByName, done)

    def each(table: pa.Table) -> pa.Table:
        turn, at, lo, hi = (table.column(c)[0].as_py() for c in ("turn", "depth", "lo", "hi"))
        keys = np.sort(table.column("key").to_numpy().view(np.uint64))
        forest = _Forest(len(keys))
        if lo == hi:
            trie_join(keys, (0, len(keys)), (0, len(keys)), at, 0, budget, forest, width, tight)
        else:
            cut = int(np.searchsorted(keys >> np.uint64(64 - at), np.uint64(hi)))
            trie_join(keys, (0, cut), (cut, len(keys)), at, (lo ^ hi).bit_count(), budget, forest, width, tight)
        place = np.arange(len(keys))
        root = forest.roots(place.copy())
        tied = root != place
        if turn:
            keys = (keys << np.uint64(64 - begins[turn])) | (keys >> np.uint64(begins[turn]))
        return pa.table({"a": keys[tied].view(np.int64), "b": keys[root[tied]].view(np.int64)})

    return dealt.groupBy("turn", "depth", "lo", "hi").applyInArrow(each, "a long, b long")


def _members(fps: DataFrame, first: Column, budget: int) -> DataFrame:
    """(fp, component, first): each distinct fingerprint's component and the least of ``first`` in its rows."""
    least = written(fps.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    tied = connected_components(near_links(least.select("fp"), budget))
    member = least.join(tied.withColumnRenamed("node", "fp"), "fp", "left")
    return written(member.select("fp", F.coalesce("component", "fp").alias("component"), "first"), "members")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, budget: int = 4, seed: int = 42) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, with all its columns.

    Of rows of that id in the group the one with the smallest fingerprint stays, then with the smallest MD5 of its text; of rows
    with the same id and text any one. A group that has null ids only keeps a row too. An empty table gives an empty one.
    """
    key = F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    fps = written(fingerprints(keyed, ("id", "key"), "text", shingle, seed), "fingerprints")
    found = _members(fps, F.struct(F.col("id").isNull().alias("none"), "id", "fp", "key"), budget)
    chosen = found.groupBy("component").agg(F.min("first").alias("x")).select(F.col("x.id").alias("_id"), F.col("x.key").alias("_key"))
    chosen = written(chosen, "chosen")
    rows = docs.withColumn("_md5", key)
    out = rows.join(chosen, rows[id_col].eqNullSafe(chosen["_id"]) & (F.col("_md5") == F.col("_key")), "left_semi")
    return out.dropDuplicates([id_col, "_md5"]).drop("_md5")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, budget: int = 4, seed: int = 42) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the smallest id that can be reached over
    fingerprints that differ in at most ``budget`` bits, its own included. Rows with null or empty texts have
    fingerprint zero and are linked like any other; repeated rows are kept; null ids are passed over in
    ``component_id`` (which is null if the component has no other). Texts are taken as bytes, valid UTF-8 or not. Other
    columns of ``docs`` don't matter; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fps = written(fingerprints(rows, ("id",), "text", shingle, seed), "fingerprints")
    member = _members(fps, F.col("id"), budget)
    heads = member.groupBy("component").agg(F.min("first").alias("component_id"))
    label = member.join(heads, "component").select("fp", "component_id")
    out = fps.join(label, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
