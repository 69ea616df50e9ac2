"""Substring dedup by level-wise doubling over words.

Windows of one length that start once have no repeated extension, so only those repeated at one
length are extended to twice that length: 6, 12, and at last the 35 words that count.  At each
length Spark counts the names of the candidates; those found twice or more are kept as a bitmap
of fixed size, which may let a few others through and never loses one.  See ``repeats`` for
how candidates are chosen and the last length is decided exactly.

Each word in a 35-word window that also starts elsewhere (in the same text, too) is removed, the
first copy included; windows are judged on the input.  A null text has no words; texts
shorter than the window lose none.  Repeated rows are copies of each other and lose all their
repeated words.  An empty table gives an empty one; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import signed, unpacked
from .repeats import ANCHORS, Shape, anchor_columns, covered, keyed, mask_of, repeated_spans, scan
from .tables import bitmap, in_bitmap, saved

SHAPE = Shape("word", window=35, spread=24, gram=6)


def _repeated_names(texts: DataFrame, shape: Shape, length: int, earlier: list[tuple[int, object]]) -> object:
    """A bitmap of the names found twice or more among candidates of a length."""

    def emit(batch, units, sums, found):
        keep = _survivors(sums, found, earlier)
        return [signed(sums.stretch(found.at[keep], found.at[keep] + length))]

    names = scan(texts, shape, emit, "name bigint")
    return bitmap(names.groupBy("name").count().where("count > 1"), F.col("name"))


def _survivors(sums, found, earlier: list[tuple[int, object]]) -> np.ndarray:
    keep = np.arange(len(found.at))
    for length, repeated in earlier:
        at = found.at[keep]
        keep = keep[in_bitmap(repeated.value, signed(sums.stretch(at, at + length)))]
    return keep


def repeated_word_spans(texts: DataFrame, shape: Shape = SHAPE) -> DataFrame:
    """``key, start, end`` (in words) that cover the words of all repeated windows."""
    share = texts.sparkSession.sparkContext.broadcast
    earlier: list[tuple[int, object]] = []
    length = shape.gram
    while length <= shape.core:
        earlier.append((length, share(_repeated_names(texts, shape, length, earlier))))
        length *= 2
    core = earlier[-1][0]

    def emit(batch, units, sums, found):
        found = type(found)(*(x[_survivors(sums, found, earlier)] for x in found))
        return anchor_columns(batch, units, sums, found, shape, core)

    anchors = saved(scan(texts, shape, emit, ANCHORS), "anchors")
    return repeated_spans(texts, anchors, shape)


def remove_repeated_words(
    table: DataFrame, *, id: str = "doc_id", text: str = "text", shape: Shape = SHAPE, digests: bool = False
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed`` and ``kept_text``: the other words, one blank between.

    With ``digests``, ``kept_sha256`` in place of the text.
    """
    texts = keyed(table, id, text)
    spans = repeated_word_spans(texts.select("key", "text"), shape)
    kind = table.schema[id].dataType.simpleString()
    last = "kept_sha256 string" if digests else "kept_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for body, found in zip(batch.column(1), batch.column(2)):
                words = unpacked(body.as_py()).split()  # bytes: splits at the six ASCII blanks
                counts.append(len(words))
                found = found.as_py()
                if found:
                    gone = mask_of(len(words), found)
                    removed.append(int(gone.sum()))
                    words = [word for word, g in zip(words, gone.tolist()) if not g]
                else:
                    removed.append(0)
                left = b" ".join(words)
                kept.append(hashlib.sha256(left).hexdigest() if digests else left.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["id", "n_words", "n_removed", last.split()[0]],
            )

    rows = covered(texts, spans).select("id", "text", "spans")
    out = rows.mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, {last}")
    return out.withColumnRenamed("id", id)
