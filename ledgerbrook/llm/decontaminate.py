"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words at the ``1`` places of a mask; words at its ``0`` places are
ignored, so a seed survives substitutions there.  Seeds of the training texts are tested
against a bitmap of the benchmark's seeds (of fixed size, only a prefilter), what is left is joined to the
benchmark's seeds, and a hit fixes an alignment of text and item.  The whole
item along the alignment is a leak when enough of its words are equal.  If not, the
overlap is extended both ways while substitutions are few, and counts as a leak when it is
long and alike enough, however long the item.  Words put in or left out split a copy into several
alignments; what they hold of the item is added up.

Words are compared in lower case and without ASCII punctuation.  Null texts and items have no
words; an item shorter than the masks' span is no evidence and never reported.  Several rows with
the same text each get their leaks.  Empty tables give no leaks; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, runs, signed, slices, texts_of, unpacked, words_of
from .repeats import keyed, ready_to_move
from .tables import bitmap, in_bitmap, saved

# The masks, by their places in a span of ten words.
MASKS = ["1111110000", "1110110001", "1101001011", "1010011101", "1011010011"]
SPAN = 10

# An overlap counts from this length on, or as a whole item, and with this share of equal words.
MIN_WORDS = 13
EQUAL_PERCENT = 70
# Extension: a substitution costs two equal words; it ends this far below the best.
SUBSTITUTION, DROP = 2, 6


def seeds(names: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: the places where it fits into a text, and the seeds there."""
    count = np.diff(first)
    last = np.repeat(first[1:], count)
    at = np.arange(len(names))
    at = at[at + SPAN <= last]
    for number, mask in enumerate(MASKS):
        total = np.full(len(at), np.uint64(number + 1))
        for place, used in enumerate(mask):
            if used == "1":
                total = (total ^ names[at + place]) * np.uint64(0x9E3779B97F4A7C15 + 2 * place)
                total ^= total >> np.uint64(29)
        yield at, mix(total)


def _item_seeds(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(texts_of(batch.column(1)), folded=True)
            found, rows, places = [], [], []
            for at, made in seeds(words.hash, words.first):
                row = np.searchsorted(words.first, at, side="right") - 1
                found.append(signed(made))
                rows.append(row)
                places.append(at - words.first[row])
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found)),
                    pa.array(keys[np.concatenate(rows)]),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                names=["seed", "item", "place"],
            )

    return items.mapInArrow(run, "seed bigint, item bigint, place int").distinct()


def _item_words(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(texts_of(batch.column(1)), folded=True)
            lists = [signed(words.hash[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int64()))], names=["item", "words"]
            )

    return items.mapInArrow(run, "item bigint, words array<bigint>").dropDuplicates(["item"])


def _hits(texts: DataFrame, benchmark_seeds: np.ndarray) -> DataFrame:
    shipped = texts.sparkSession.sparkContext.broadcast(benchmark_seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(texts_of(batch.column(1)), folded=True)
            found, rows, places = [], [], []
            for at, made in seeds(words.hash, words.first):
                hit = in_bitmap(shipped.value, signed(made))
                at = at[hit]
                row = np.searchsorted(words.first, at, side="right") - 1
                found.append(signed(made[hit]))
                rows.append(row)
                places.append(at - words.first[row])
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found)),
                    pa.array(keys[np.concatenate(rows)]),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                names=["seed", "key", "at"],
            )

    return texts.mapInArrow(run, "seed bigint, key bigint, at int")


def overlap(equal: np.ndarray) -> tuple[int, int]:
    """The stretch of an alignment with the best score: equal words less substitutions, as weighted."""
    score = np.where(equal, 1, -SUBSTITUTION)
    best, best_at, start, total = 0, (0, 0), 0, 0
    for i, step in enumerate(score.tolist()):
        total += step
        if total <= 0 or total < best - DROP and total <= step:
            total, start = 0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def longest(equal: np.ndarray) -> tuple[int, int]:
    """The longest stretch that begins and ends with an equal word and has enough of them."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    # Stretch i to j is alike enough if value[j] - value[i] is EQUAL_PERCENT - 100 or more.
    value = 100 * np.arange(len(at)) - EQUAL_PERCENT * at
    ahead = np.maximum.accumulate(value[::-1])  # ahead[n - 1 - j]: the most from j on
    last = len(at) - 1 - np.searchsorted(ahead, value + EQUAL_PERCENT - 100)
    i = int(np.argmax(at[last] - at))
    return int(at[i]), int(at[last[i]]) + 1


def dense(equal: np.ndarray) -> np.ndarray:
    """The equal words inside windows of the masks' span that are alike enough."""
    sums = np.concatenate([[0], np.cumsum(equal)])
    start = np.flatnonzero(100 * (sums[SPAN:] - sums[:-SPAN]) >= EQUAL_PERCENT * SPAN)
    return equal & runs(len(equal), start, start + SPAN)


def judged(own: np.ndarray, item: np.ndarray, shifts: list[int]) -> tuple[int, int, int] | None:
    """Length, equal words and start in the text of the best overlap that is a leak, over all alignments.

    An alignment is one as a whole item or by a stretch of ``MIN_WORDS``, however long the item.  Else
    what all alignments hold of the item is added up, as words put in or left out move the rest of a copy.
    """
    best, covered, start = None, np.zeros(len(item), bool), len(own)
    for shift in shifts:
        low, high = max(0, shift), min(len(own), shift + len(item))
        equal = own[low:high] == item[low - shift : high - shift]
        same = int(equal.sum())
        if same and 100 * same >= EQUAL_PERCENT * len(item):
            found = [(same, len(equal), -low)]
        else:
            found = [(int(equal[a:b].sum()), b - a, -(low + a)) for a, b in (overlap(equal), longest(equal))]
            found = [x for x in found if x[1] >= MIN_WORDS and 100 * x[0] >= EQUAL_PERCENT * x[1]][:1]
        best = max([*found, *([best] if best else [])], default=None)
        held = dense(equal)
        if held.any():
            covered[low - shift : high - shift] |= held
            start = min(start, low + int(held.argmax()))
    same = int(covered.sum())
    if 100 * same >= EQUAL_PERCENT * len(item) and (best is None or same > best[0]):
        best = same, len(item), -start
    return (best[1], best[0], -best[2]) if best else None


def _verified(rows: DataFrame) -> DataFrame:
    """Leaks among aligned pairs; a row is a text with its alignments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bodies = pa.array([unpacked(body.as_py()) for body in batch.column(1)], pa.binary())
            words = words_of(texts_of(bodies), folded=True)
            out: list[tuple] = []
            for i, (key, aligned) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                own = signed(words.hash[words.first[i] : words.first[i + 1]])
                pairs: dict = {}
                for pair in aligned.as_py():
                    pairs.setdefault(pair["item"], (pair["words"], []))[1].append(pair["shift"])
                for item, (item_words, shifts) in pairs.items():
                    if leak := judged(own, np.array(item_words, np.int64), sorted(shifts)):
                        out.append((key, item, *leak, len(item_words)))
            kinds = [pa.int64()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)],
                names=["key", "item", "n_overlap", "n_equal", "start", "n_item"],
            )

    schema = "key bigint, item bigint, n_overlap bigint, n_equal bigint, start bigint, n_item bigint"
    found = rows.mapInArrow(run, schema)
    return found.groupBy("key", "item").agg(
        F.max_by(F.struct("n_overlap", "n_equal", "start", "n_item"), F.struct("n_equal", "n_overlap", -F.col("start"))).alias("m")
    ).select("key", "item", "m.*")


def _leaks(texts: DataFrame, items: DataFrame) -> DataFrame:
    item_seeds = saved(_item_seeds(items), "seeds")
    hits = saved(_hits(texts, bitmap(item_seeds, F.col("seed"))), "hits")
    aligned = hits.join(item_seeds, "seed").select("key", "item", (F.col("at") - F.col("place")).alias("shift"))
    aligned = saved(aligned.distinct(), "aligned")
    keys = bitmap(aligned.select("key").distinct(), F.col("key"))
    pairs = aligned.join(_item_words(items), "item")
    lists = pairs.groupBy("key").agg(F.collect_list(F.struct("item", "shift", "words")).alias("aligned"))
    rows = ready_to_move(texts, keys).dropDuplicates(["key"]).join(lists, "key")
    return _verified(rows.select("key", "text", "aligned"))


def leaks(
    table: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id, item_id, n_overlap, n_equal, start, n_item`` of each leak: the best overlap of text and item."""
    texts = keyed(table, id, text)
    items = keyed(benchmark, item_id, item_text)
    found = saved(_leaks(texts.select("key", "text"), items.select("key", "text")), "leaks")
    names = texts.select("key", F.col("id").alias(id))
    item_names = items.select(F.col("key").alias("item"), F.col("id").alias(item_id))
    return found.join(names, "key").join(item_names, "item").select(id, item_id, "n_overlap", "n_equal", "start", "n_item")


def clean(table: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of the table without a leak, all columns as they are."""
    texts = keyed(table, id, text).select("key", "text")
    found = saved(_leaks(texts, keyed(benchmark, item_id, item_text).select("key", "text")), "leaks")
    mark = "__key"
    while mark in table.columns:
        mark += "_"
    body = F.col(f"`{text}`").cast("binary")
    marked = table.withColumn(mark, F.xxhash64(F.col(f"`{id}`"), body))
    leaked = found.select(F.col("key").alias(mark)).distinct()
    return marked.join(leaked, mark, "left_anti").drop(mark)
