"""Windows of a fixed length that start more than once in a table of texts.

What the two exact substring operators share.  A text is a sequence of units (words or bytes).

Every window is owned by its *anchor*: the leftmost smallest fingerprint among the first
``spread`` grams of the window.  The anchor depends on the window's content alone, so equal
windows have anchors at the same offset, and the starts that an anchor owns are consecutive.
It is therefore enough to look at anchors, about two per ``spread`` units, and a unit is
looked at by itself only at the rims of repeated stretches:

* an anchor whose *core* (the part all its windows share) is found once has no repeated window;
* anchors that own the same starts, with the same units from the first start to the end of
  the last window, are a *class*; in a class of two or more all windows are repeated;
* where a core has classes of one beside others, the windows of those, and of one member of every
  other class, are compared one by one.  Each is a row; rows of a window are counted map-side first.

No step gathers the places of a window, so a passage that a third of the texts share is as many
rows as it has places, dealt by joins that can be split.  Texts are identified by a hash of
their id and content; repeated rows therefore get the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Sequences, Texts, mix, packed, signed, slices, texts_of, unpacked, words_of
from .tables import bitmap, discard, in_bitmap, release, saved

BYTE_SLICE = 1 << 20
_BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64))


class Shape(NamedTuple):
    """Window length; grams at the start of a window that may be its anchor; length of a gram."""

    unit: str  # "word" or "byte"
    window: int
    spread: int
    gram: int

    @property
    def core(self) -> int:
        """The longest stretch from an anchor that lies inside all its windows."""
        return self.window - self.spread + 1

    @property
    def block(self) -> int:
        """Window starts that are first looked at together."""
        return max(1, self.spread // 12)


class Anchors(NamedTuple):
    """Places in a slice: its text, the anchor, the first and the last window start it owns."""

    text: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Units(NamedTuple):
    """The units of a slice of texts: text i has the units first[i] to first[i + 1]."""

    names: np.ndarray
    first: np.ndarray


def units_of(texts: Texts, unit: str) -> Units:
    if unit == "byte":
        return Units(_BYTE_NAMES[texts.data], texts.offsets)
    words = words_of(texts)
    return Units(words.hash, words.first)


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the leftmost smallest of values[i:i + width]."""
    place = np.arange(len(values), dtype=np.int32)

    def join(step: int) -> None:
        nonlocal values, place
        right = values[step:] < values[:-step]
        place = np.where(right, place[step:], place[:-step])
        values = np.where(right, values[step:], values[:-step])

    span = 1
    while span * 2 <= width:
        join(span)
        span *= 2
    if span < width:
        join(width - span)
    return place


def anchors_of(units: Units, sums: Sequences, shape: Shape) -> Anchors:
    first, n = units.first, len(units.names)
    none = np.zeros(0, np.int64)
    starts = np.ones(max(n - shape.window + 1, 0), dtype=bool)
    for low, high in zip(first[:-1], first[1:]):
        starts[max(low, high - shape.window + 1) : high] = False
    starts = np.flatnonzero(starts)
    if not len(starts):
        return Anchors(none, none, none, none)
    anchor = _leftmost_smallest(sums.all_of(shape.gram), shape.spread)[starts].astype(np.int64)
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))
    begin = np.concatenate([[0], cut + 1])
    end = np.concatenate([cut, [len(starts) - 1]])
    low = starts[begin]
    return Anchors(np.searchsorted(first, low, side="right") - 1, anchor[begin], low, starts[end])


Scan = Callable[[pa.RecordBatch, Units, Sequences, Anchors], list]


def scan(texts: DataFrame, shape: Shape, emit: Scan, schema: str) -> DataFrame:
    """``emit`` over slices of the columns ``key, text``: returns the arrays of the schema's columns."""
    names = [field.split()[0] for field in schema.split(", ")]
    limit = BYTE_SLICE if shape.unit == "byte" else 2 * BYTE_SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit):
            units = units_of(texts_of(batch.column(1)), shape.unit)
            sums = Sequences(units.names)
            made = emit(batch, units, sums, anchors_of(units, sums, shape))
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in made], names=names)

    return texts.mapInArrow(run, schema)


ANCHORS = "key bigint, at int, low int, high int, core bigint, class bigint"


def anchor_columns(
    batch: pa.RecordBatch, units: Units, sums: Sequences, found: Anchors, shape: Shape, core: int
) -> list[np.ndarray]:
    """The columns of ``ANCHORS``: the key of the text, the anchor, the first and last start (from the
    text's start), the name of ``core`` units from the anchor on, and the name of the class."""
    key = batch.column(0).to_numpy(zero_copy_only=False)
    begin = units.first[found.text]
    whole = sums.stretch(found.low, found.high + shape.window)
    offsets = (found.at - found.low).astype(np.uint64) << np.uint64(32) | (found.high - found.low).astype(np.uint64)
    return [
        key[found.text],
        (found.at - begin).astype(np.int32),
        (found.low - begin).astype(np.int32),
        (found.high - begin).astype(np.int32),
        signed(sums.stretch(found.at, found.at + core)),
        signed(mix(whole ^ mix(offsets))),
    ]


def ready_to_move(texts: DataFrame, keys: np.ndarray | None = None) -> DataFrame:
    """The texts (``key, text`` and more) packed for a shuffle; of a bitmap of keys, only those in it.

    The bitmap lets a few others through.
    """
    shipped = texts.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shipped.value is not None:
                hit = in_bitmap(shipped.value, batch.column(0).to_numpy(zero_copy_only=False))
                batch = batch.filter(pa.array(hit))
            small = pa.array([packed(body.as_py()) for body in batch.column(1)], pa.binary())
            yield batch.set_column(1, "text", small)

    return texts.mapInArrow(run, texts.schema)


class Ranges(NamedTuple):
    """Window starts of a slice, with their text, their key, and their place before the anchor."""

    start: np.ndarray
    text: np.ndarray
    ahead: np.ndarray


def _ranges(batch: pa.RecordBatch, units: Units) -> Ranges:
    lists = batch.column(2)
    items = lists.flatten()
    text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    at, low, high = (items.field(i).to_numpy() + units.first[text] for i in range(3))
    count = high - low + 1
    start = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    return Ranges(start, np.repeat(text, count), np.repeat(at, count) - start)


def _block_cores(found: Ranges, sums: Sequences, shape: Shape) -> np.ndarray:
    """For each start, the name of what all windows of its block share.

    Blocks are counted from the anchor, so equal windows lie in equal places of blocks with
    the same core, also where a range holds only part of a block.
    """
    last = found.start + found.ahead % shape.block
    return signed(sums.stretch(last, last - shape.block + 1 + shape.window))


def _compared(texts: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """``name, key, start`` of the windows of the wanted anchors (``key, at, low, high``).

    Windows whose block has a core found once are left out: they cannot be repeated.
    """
    ranges = wanted.groupBy("key").agg(F.collect_set(F.struct("at", "low", "high")).alias("ranges"))
    some = ready_to_move(texts, bitmap(wanted.select("key").distinct(), F.col("key")))
    joined = some.dropDuplicates(["key"]).join(ranges, "key").select("key", "text", "ranges")
    joined = saved(joined, "compared")

    def each(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text", BYTE_SLICE // 3):
            bodies = pa.array([unpacked(body.as_py()) for body in batch.column(1)], pa.binary())
            units = units_of(texts_of(bodies), shape.unit)
            sums = Sequences(units.names)
            found = _ranges(batch, units)
            yield batch, units, sums, found, _block_cores(found, sums, shape)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, found, cores in each(batches):
            # The first start of each block of a range.
            number = (found.start + found.ahead) * shape.spread + found.ahead // shape.block
            first = np.concatenate([[True], number[1:] != number[:-1]]) if len(number) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array((cores[first] >> 32).astype(np.int32))], names=["core"])

    cores = joined.mapInArrow(blocks, "core int").groupBy("core").count().where("count > 1")
    shipped = texts.sparkSession.sparkContext.broadcast(bitmap(cores, F.col("core").cast("bigint")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, units, sums, found, cores in each(batches):
            keep = in_bitmap(shipped.value, cores >> 32)
            start, text = found.start[keep], found.text[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(sums.stretch(start, start + shape.window))),
                    pa.array(batch.column(0).to_numpy(zero_copy_only=False)[text]),
                    pa.array((start - units.first[text]).astype(np.int32)),
                ],
                names=["name", "key", "start"],
            )

    found = saved(joined.mapInArrow(windows, "name bigint, key bigint, start int"), "windows")
    discard(joined)
    return found


def repeated_spans(texts: DataFrame, anchors: DataFrame, shape: Shape) -> DataFrame:
    """``key, start, end`` of stretches that together are all units in repeated windows.

    ``anchors`` has the columns ``ANCHORS`` for at least all anchors whose core is found twice or more.
    """
    release(texts.sparkSession)
    one = F.min(F.struct("key", "at", "low", "high")).alias("one")
    classes = anchors.groupBy("class").agg(F.count("*").alias("n"), F.first("core").alias("core"), one)
    classes = saved(classes, "classes")
    sure = anchors.join(classes.where("n > 1").select("class"), "class", "left_semi")
    sure = sure.select("key", F.col("low").alias("start"), (F.col("high") + shape.window).alias("end"))
    open_cores = classes.groupBy("core").agg(F.count("*").alias("classes"), F.min("n").alias("least"))
    open_cores = open_cores.where("classes > 1 and least = 1").select("core")
    wanted = saved(classes.join(open_cores, "core", "left_semi").select("one.*"), "wanted")
    release(texts.sparkSession)
    windows = _compared(texts, wanted, shape)
    discard(wanted)
    release(texts.sparkSession)
    twice = windows.groupBy("name").count().where("count > 1").select("name")
    found = windows.join(twice, "name", "left_semi")
    found = found.select("key", "start", (F.col("start") + shape.window).alias("end"))
    return sure.unionByName(found)


def covered(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts, packed, with ``spans``: the set of a text's spans, null where it has none."""
    lists = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return ready_to_move(texts).join(lists, "key", "left")


def keyed(table: DataFrame, id: str, text: str) -> DataFrame:
    """``key, text, id``: the text as bytes, the key a hash of both."""
    body = F.col(f"`{text}`").cast("binary")
    return table.select(
        F.xxhash64(F.col(f"`{id}`"), body).alias("key"), F.coalesce(body, F.lit(b"")).alias("text"),
        F.col(f"`{id}`").alias("id"),
    )


def mask_of(size: int, spans: list[dict] | None) -> np.ndarray:
    """Which of ``size`` units are in any span."""
    change = np.zeros(size + 1, np.int32)
    if spans:
        np.add.at(change, [s["start"] for s in spans], 1)
        np.add.at(change, [s["end"] for s in spans], -1)
    return np.cumsum(change[:-1]) > 0
