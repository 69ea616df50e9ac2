"""Suffix-array dedup of bytes by distributed prefix doubling.

Ranked are the suffixes that start at anchors (see ``repeats``: every 200-byte string has one, at
the same offset wherever it is found), at first by the name of their first 26 bytes.  A round
sorts the pairs (rank so far, name of as many bytes that follow) across the cluster and numbers the
distinct pairs in that order: the rank at twice the length.  A suffix whose pair is found once is unique
from there on and leaves.  What follows an anchor is no anchor itself and has no rank, so
it is named by a fingerprint; the order is that of names, as removal only asks which suffixes are equal.
The ranks reach 52 and 104 bytes.  The next doubling would pass what all windows of an
anchor share, so what is left is decided at 200 bytes exactly.

Each byte covered by a 200-byte string that also starts elsewhere (in the same text, too) is
removed, the first copy included; strings are judged on the input and never cross texts.  A
null text is empty; texts shorter than the string lose nothing.  Repeated rows are copies of
each other.  An empty table gives an empty one; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import signed, unpacked
from .repeats import ANCHORS, Anchors, Shape, anchor_columns, covered, keyed, mask_of, repeated_spans, scan
from .tables import bitmap, discard, in_bitmap, release, saved

SHAPE = Shape("byte", window=200, spread=96, gram=26)


def rounds_of(shape: Shape) -> list[int]:
    """The offsets of the rounds: each ranks suffixes at twice its length, within what all windows share."""
    rounds = []
    length = shape.gram
    while 2 * length <= shape.core:
        rounds.append(length)
        length *= 2
    return rounds


def reranked(suffixes: DataFrame, ahead: str) -> DataFrame:
    """The suffixes whose pair (``rank``, ``ahead``) is found twice or more, ranked by the place of the pair."""
    pairs = suffixes.groupBy("rank", ahead).count().where("count > 1").select("rank", ahead)
    # Numbers follow the layout of the sort, so they are written and never made twice.
    order = saved(pairs.orderBy("rank", ahead).withColumn("place", F.monotonically_increasing_id()), "ranks")
    left = suffixes.join(order, ["rank", ahead]).drop("rank", ahead).withColumnRenamed("place", "rank")
    left = saved(left, "suffixes")
    discard(order)
    discard(suffixes)
    release(suffixes.sparkSession)
    return left


def repeated_byte_spans(texts: DataFrame, shape: Shape = SHAPE) -> DataFrame:
    """``key, start, end`` (in bytes) that cover the bytes of all repeated windows."""
    rounds = rounds_of(shape)

    def short(sums, found) -> np.ndarray:
        """The names of the first grams in 32 bits: two may share one, none is lost."""
        return (sums.stretch(found.at, found.at + shape.gram) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    names = scan(texts, shape, lambda batch, units, sums, found: [short(sums, found)], "name int")
    twice = bitmap(names.groupBy("name").count().where("count > 1"), F.col("name").cast("bigint"))
    repeated = texts.sparkSession.sparkContext.broadcast(twice)

    def emit(batch, units, sums, found):
        keep = in_bitmap(repeated.value, short(sums, found))
        found = Anchors(*(x[keep] for x in found))
        ahead = [signed(sums.stretch(found.at + n, found.at + 2 * n)) for n in rounds]
        return [*anchor_columns(batch, units, sums, found, shape, shape.gram), *ahead]

    nexts = [f"next{n}" for n in rounds]
    schema = ", ".join([ANCHORS, *(f"{name} bigint" for name in nexts)])
    suffixes = saved(scan(texts, shape, emit, schema).withColumnRenamed("core", "rank"), "suffixes")
    for name in nexts:
        suffixes = reranked(suffixes, name)
    return repeated_spans(texts, suffixes.withColumnRenamed("rank", "core"), shape)


def remove_repeated_bytes(
    table: DataFrame, *, id: str = "doc_id", text: str = "text", shape: Shape = SHAPE, digests: bool = False
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    With ``digests``, ``kept_sha256`` in place of the bytes.
    """
    texts = keyed(table, id, text)
    spans = repeated_byte_spans(texts.select("key", "text"), shape)
    kind = table.schema[id].dataType.simpleString()
    last = "kept_sha256 string" if digests else "kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, found in zip(batch.column(1), batch.column(2)):
                raw, found = unpacked(body.as_py()), found.as_py()
                gone = mask_of(len(raw), found)
                rims = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1)
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw
                rows.append(
                    (len(raw), len(raw) - len(left), len(rims), hashlib.sha256(left).hexdigest() if digests else left)
                )
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digests else pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["id", "n_bytes", "n_removed", "n_spans", last.split()[0]],
            )

    rows = covered(texts, spans).select("id", "text", "spans")
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {last}")
    return out.withColumnRenamed("id", id)
