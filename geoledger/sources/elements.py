"""The elements of large JSON files' arrays, read in Spark's own splits.

A file is one object whose arrays hold objects, however long its lines are. It is cut after each ``}``, and the pieces of a split
that follow each other are kept together as chunks. A chunk knows by sums over the chunks before it (within its split, and of the
splits before) whether it begins inside a string and how deep, and then which array it begins in; it then gives its whole elements
by itself. Only what crosses a chunk's edge is put together by a shuffle, so that no file is one row, no task reads more than its
split, and the text isn't dealt. Within a chunk the marks (quotes and brackets) are looked at all at once, not element by element.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from geoledger.scratch import drop_written, written

_QUOTE, _BRACE, _BRACKET = b'"{['
_STEPS = np.zeros(256, np.int64)
_STEPS[list(b"{[")], _STEPS[list(b"}]")] = 1, -1
_IS_MARK = _STEPS != 0
_IS_MARK[_QUOTE] = True
_CHUNK = 1 << 19
_CHUNKS = "file long, split long, at long, quotes long, outside long, inside long, value string"
_EDGES = "file long, split long, at long, within boolean, depth long, kind string, field string, ord long, value string, elements long, before long, open long"
_ELEMENTS = "file string, field string, ord long, value string"


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of quotes and brackets, save those after a backslash, and their bytes."""
    plain = np.frombuffer(re.sub(rb"\\.", b"  ", text, flags=re.DOTALL) if b"\\" in text else text, np.uint8)
    at = np.flatnonzero(_IS_MARK[plain])
    return at, plain[at]


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Parts of a text that follow each other."""
    if not len(starts):
        return pa.array([], pa.binary())
    # With what lies between them, every other part of a gapless array.
    edges = np.stack([starts, ends], 1).astype(np.int32).ravel()
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(text)]).take(pa.array(np.arange(0, len(edges), 2)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring pieces of a split as one text, with its quotes, and how deep it leads if it begins outside or inside a string.

    A split is read in order, by one task; ``at`` is a chunk's own number, which rises within a split.
    """
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, value = (batch.column(k) for k in range(3))
        sizes = pc.cumulative_sum(pc.add(pc.cast(pc.binary_length(value), pa.int64()), 1))
        ends = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in (file, split, pc.divide(sizes, _CHUNK))]
        last = pc.indices_nonzero(pc.or_(pc.or_(ends[0], ends[1]), ends[2])).to_pylist()
        edges = [0, *[k + 1 for k in last], batch.num_rows]
        pieces = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), value.cast(pa.binary()))
        texts = pc.binary_join_element_wise(pc.binary_join(pieces, b"}"), b"", b"}")
        sums = []
        for text in texts.to_pylist():
            marks = _marks(text)[1]
            quote, steps = marks == _QUOTE, _STEPS[marks]
            odd = np.cumsum(quote) % 2 == 1
            sums.append((at, int(quote.sum()), int(steps[~odd].sum()), int(steps[odd].sum())))
            at += 1
        first = pa.array(edges[:-1])
        yield pa.RecordBatch.from_arrays([file.take(first), split.take(first), *[pa.array(c, pa.int64()) for c in zip(*sums, strict=True)], texts.view(pa.string())], names=["file", "split", "at", "quotes", "outside", "inside", "value"])


class _Found(NamedTuple):
    """What a chunk holds; places count from the chunk's begin, or from that of the array if it begins here."""

    #: The end of an element that began before, the whole length if it ends later; null if there is none.
    head: int | None
    #: Names of the arrays that begin here, empty for an object in their place.
    names: pa.Array
    #: Whole elements: begin, end, the array that they are in (-1: it began before) and place.
    starts: np.ndarray
    ends: np.ndarray
    array: np.ndarray
    place: np.ndarray
    #: Begin, array and place (null for no object) of an element that ends later.
    tail: tuple[int, int, int | None] | None
    #: Objects that begin here, and those before the last array that begins here.
    elements: int
    before: int


def _found(text: bytes, inside: bool, depth: int) -> _Found:
    at, marks = _marks(text)
    quote = marks == _QUOTE
    # Brackets in strings are none.
    real = quote | ((np.cumsum(quote) + inside) % 2 == 0)
    at, marks, quote = at[real], marks[real], quote[real]
    steps = _STEPS[marks]
    after = depth + np.cumsum(steps)
    arrays, firsts = (np.flatnonzero((steps == 1) & (after == d)) for d in (2, 3))
    lasts = np.flatnonzero((steps == -1) & (after == 2))
    head = None
    if depth > 2:
        head, lasts = (int(at[lasts[0]]) + 1 if len(lasts) else len(text)), lasts[1:]
    # The name of an array is the string before it. The end of a string that begins before the chunk isn't one.
    named = (marks[arrays] == _BRACKET) & (arrays >= 2) & quote[arrays - 1] & quote[arrays - 2]
    names = _cut(text, np.where(named, at[arrays - 2] + 1, at[arrays]), np.where(named, at[arrays - 1], at[arrays]))
    objects = marks[firsts] == _BRACE
    so_far = np.concatenate([[0], np.cumsum(objects)])
    # Objects before each array, and none before the chunk.
    base = np.append(so_far[np.searchsorted(firsts, arrays)], 0)
    array = np.searchsorted(arrays, firsts) - 1
    place = so_far[:-1] - base[array]
    whole = np.flatnonzero(objects[: len(lasts)])
    tail = None
    if len(firsts) > len(lasts):
        tail = int(at[firsts[-1]]), int(array[-1]), int(place[-1]) if objects[-1] else None
    return _Found(head, names, at[firsts[whole]], at[lasts[whole]] + 1, array[whole], place[whole], tail, int(so_far[-1]), int(base[len(arrays) - 1]))


def _walk(text: str, inside: bool, depth: int, whole: bool = True) -> Iterator[tuple]:
    """(kind, array, place, text, 0, 0, 0) of each element that is whole, begins (``tail``) or goes on (``head``) in a chunk, and a ``sum``.

    The array is null, and the place counts from the chunk's begin, before an array begins here. The sum has the last array that
    begins here, '' for an object in its place, the number of elements that begin here, of those before that array, and of tails.
    """
    raw = text.encode()
    found = _found(raw, inside, depth)
    name = lambda k: found.names[k].as_py().decode() if k >= 0 else None
    if found.head is not None:
        yield "head", None, None, raw[: found.head].decode(), 0, 0, 0
    if whole:
        for start, end, k, place in zip(*[c.tolist() for c in (found.starts, found.ends, found.array, found.place)], strict=True):
            yield "whole", name(k), place, raw[start:end].decode(), 0, 0, 0
    if found.tail:
        start, k, place = found.tail
        yield "tail", name(k), place, raw[start:].decode(), 0, 0, 0
    yield "sum", name(len(found.names) - 1), None, None, found.elements, found.before, int(found.tail is not None)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each chunk, and what of it is not whole."""
    kinds = [*[pa.int64()] * 3, pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
    for batch in batches:
        rows = [(*place, inside, depth, *r) for *place, text, inside, depth in zip(*[c.to_pylist() for c in batch.columns], strict=True) for r in _walk(text, inside, depth, whole=False)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _EDGES.split(", ")])


def _parsed(texts: pa.Array, kind: pa.Schema) -> pa.Array | None:
    """Records of objects in plain JSON; null if Arrow's reader doesn't take one of them as it stands, whatever the reason."""
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), b"\n")[0].as_buffer()
    how = json.ParseOptions(explicit_schema=kind, newlines_in_values=True, unexpected_field_behavior="ignore")
    try:
        read = json.read_json(pa.BufferReader(lines), read_options=json.ReadOptions(use_threads=False, block_size=lines.size + 1), parse_options=how)
    except pa.ArrowInvalid:
        return None
    return read.combine_chunks().to_struct_array().combine_chunks() if len(read) == len(texts) else None


def _whole(fields: list[str], kinds: dict[str, pa.Schema]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The whole elements of chunks, which know the array that they begin in and the place of their first element in it.

    Those of arrays in ``kinds`` come as records, and a chunk's as text if one of them isn't plain.
    """
    asked = pa.array(fields)
    types = {k: pa.struct(list(s)) for k, s in kinds.items()}
    names = ["file", "field", "ord", "value", *kinds]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, text, inside, depth, section, base = (c[k] for c in batch.columns)
                text = text.cast(pa.binary()).as_py()
                found = _found(text, inside.as_py(), depth.as_py())
                # Elements before the first array that begins here are in the last one of the chunks before.
                named = pa.concat_arrays([found.names.view(pa.string()), pa.array([section.as_py()], pa.string())])
                field = pc.fill_null(pc.index_in(named, asked), -1).to_numpy()[found.array]
                place = found.place + np.where(found.array < 0, base.as_py() or 0, 0)
                for at, name in enumerate(fields):
                    mine = field == at
                    n = int(mine.sum())
                    if not n:
                        continue
                    value = _cut(text, found.starts[mine], found.ends[mine])
                    records = _parsed(value, kinds[name]) if name in kinds else None
                    columns = [records if name == k and records else pa.nulls(n, t) for k, t in types.items()]
                    yield pa.RecordBatch.from_arrays([pa.repeat(file, n), pa.repeat(name, n), pa.array(place[mine]), pa.nulls(n, pa.string()) if records else value.view(pa.string()), *columns], names=names)

    return each


def _with_sums(chunks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Each of ``sums`` over the chunks of the same file that come before."""
    before = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunks.groupBy("file", "split").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = totals.select("file", "split", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    inner = chunks.withColumns({n: F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()})
    return inner.join(offsets, ["file", "split"]).withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop(*[f"_{n}" for n in sums])


def _with_last(chunks: DataFrame, name: str, value: Column) -> DataFrame:
    """The last ``value`` that isn't null of the chunks of the same file that come before."""
    before = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunks.groupBy("file", "split").agg(F.max_by(value, F.when(value.isNotNull(), F.col("at"))).alias("_last"))
    offsets = totals.select("file", "split", F.last("_last", ignorenulls=True).over(earlier).alias("_last"))
    inner = chunks.withColumn(name, F.last(value, ignorenulls=True).over(before))
    return inner.join(offsets, ["file", "split"]).withColumn(name, F.coalesce(name, "_last")).drop("_last")


def _elements(spark: SparkSession, path: str, fields: list[str], kinds: dict[str, StructType], named: bool) -> DataFrame:
    """(file, field, ord, value) and a column of records for each of ``kinds``: of an element the text or the record is null, and the file unless ``named``."""
    # A file's name is long beside a piece: its hash stands for it (of a million files two meet by chance once in 37 million times).
    name, start = F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    # Other plans may split the files otherwise, so that the chunks are written once.
    chunks = written(spark.read.option("lineSep", "}").text(path).select(name, start, "value").mapInArrow(_chunks, _CHUNKS), "chunks")
    sums = _with_sums(chunks.drop("value"), {"marks": F.col("quotes")}).withColumn("within", F.col("marks") % 2 == 1)
    states = written(_with_sums(sums, {"depth": F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))}).select("at", "within", "depth"), "states")
    edges = written(chunks.select("file", "split", "at", "value").join(states, "at").select("file", "split", "at", "value", "within", "depth").mapInArrow(_edges, _EDGES), "edges")
    drop_written(states)
    ends = _with_sums(edges.where("kind = 'sum'").drop("kind", "ord", "value"), {"earlier": F.col("elements"), "groups": F.col("open")})
    turn = F.when(F.col("field").isNotNull(), F.struct("field", (F.col("earlier") + F.col("before")).alias("base")))
    since = (F.col("earlier") - F.col("turn.base")).alias("base")
    last = _with_last(ends, "turn", turn)
    if named:
        # No contents are read for the names.
        names = spark.read.format("binaryFile").load(path).select(name, F.col("_metadata.file_path").alias("name"))
        last = last.join(names, "file", "left")
    else:
        last = last.withColumn("name", F.lit(None).cast("string"))
    bases = written(last.select("at", "name", "within", "depth", "groups", F.col("turn.field").alias("section"), since), "bases")
    columns = StructType.fromDDL(_ELEMENTS)
    for k, t in kinds.items():
        columns = columns.add(k, t)
    whole = _whole(fields, {k: to_arrow_schema(t) for k, t in kinds.items()})
    here = chunks.select("at", "value").join(bases, "at").select("name", "value", "within", "depth", "section", "base").mapInArrow(whole, columns)
    local, broken = F.col("field").isNull(), edges.where("kind <> 'sum'").select("file", "split", "at", "kind", "field", "ord", "value")
    placed = broken.join(bases, "at").withColumns({"ord": F.when(local, F.col("ord") + F.col("base")).otherwise(F.col("ord")), "field": F.coalesce("field", "section")})
    cut = placed.withColumn("group", F.col("groups") + (F.col("kind") == "tail").cast("long"))
    held = cut.groupBy("file", "group").agg(F.sort_array(F.collect_list(F.struct("split", "at", "kind", "field", "ord", "value", "name"))).alias("parts"))
    begin = F.col("parts")[0]
    joined = held.where(begin["kind"] == "tail").select(begin["name"].alias("file"), begin["field"].alias("field"), begin["ord"].alias("ord"), F.array_join("parts.value", "").alias("value"))
    return here.unionByName(joined.where(F.col("field").isin(fields) & F.col("ord").isNotNull()), allowMissingColumns=True)


def json_elements(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """(file, field, ord, value): the JSON text of each object in the arrays ``fields`` of each file's object, counted from 0.

    Elements that are no objects are passed over; an array that isn't there, or a file that holds no object, gives no row. Of two
    arrays of one name both are read. The text is written once, as chunks; elements are cut from them when they are asked for.
    Sums have a row a chunk, and are written too, so that Spark sends them to the chunks while they are small.
    """
    return _elements(spark, path, fields, {}, named=True)


def json_records(spark: SparkSession, path: str, kinds: dict[str, str]) -> DataFrame:
    """(field, ord) and a column for each of ``kinds``: the elements of :func:`json_elements` as ``from_json`` reads them.

    Arrow's reader takes a chunk's elements at once where they are plain; all others are left to ``from_json``.
    """
    elements = _elements(spark, path, list(kinds), {k: StructType.fromDDL(s) for k, s in kinds.items()}, named=False)
    text = lambda k: F.when(F.col("field") == k, F.col("value"))
    return elements.select("field", "ord", *[F.coalesce(k, F.from_json(text(k), s)).alias(k) for k, s in kinds.items()])
