"""Whole columns of text as numpy arrays, inside Arrow batches.

A batch is cut into slices of a few megabytes of text (a longer document is a slice of its
own), so that memory follows the slice and the longest document, never the partition.
Words are ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes.  Words and sequences of words or bytes
are named by 64-bit fingerprints; two different ones share a name with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Lower case, and ASCII punctuation as blanks.
FOLDED = _LOWER.copy()
FOLDED[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 0x20


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which close inputs get unrelated outputs."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


class Texts(NamedTuple):
    """Texts laid end to end: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """The words of some texts: fingerprints, byte ranges, and the first word of each text."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # text i has the words first[i] to first[i + 1]


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a binary column; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    data = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets - low if len(column) else np.zeros(1, np.int64))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut so that a slice holds about ``limit`` bytes of a column."""
    for batch in batches:
        sizes = texts_of(batch.column(batch.schema.get_field_index(column))).offsets
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1
            to = max(at + 1, to)
            yield batch.slice(at, to - at)
            at = to


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of words, eight bytes at a time."""
    length = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    state = mix(length.astype(np.uint64) * np.uint64(_MULTIPLIER))
    rest = np.arange(len(start))
    at, left = start, length
    while len(rest):
        part = eights[at]
        short = left < 8
        keep = np.where(short, left, 0).astype(np.uint64) * np.uint64(8)
        part = np.where(short, part & ((np.uint64(1) << keep) - np.uint64(1)), part)
        state[rest] = mix((state[rest] ^ part) * np.uint64(_MULTIPLIER) + np.uint64(1))
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    return state


def words_of(texts: Texts, *, lower: bool = False, folded: bool = False) -> Words:
    """The words as they are, with A-Z in lower case, or ``folded``: without ASCII punctuation, too."""
    data, offsets = texts
    if lower or folded:
        data = (FOLDED if folded else _LOWER)[data]
    inside = ~_SPACE[data]
    starts = inside.copy()
    ends = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    return Words(_word_hashes(data, start, end), start, end, np.searchsorted(start, offsets))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0..count-1, modulo 2**64."""
    known = powers.__dict__.get("known")
    if known is None or len(known[0]) < count:
        size = max(count, 1 << 16)
        up = np.full(size, np.uint64(_BASE))
        down = np.full(size, np.uint64(_INVERSE))
        up[0] = down[0] = 1
        known = np.multiply.accumulate(up), np.multiply.accumulate(down)
        powers.known = known
    return known[0][:count], known[1][:count]


class Sequences:
    """Fingerprints of any stretch of a sequence of 64-bit names."""

    def __init__(self, names: np.ndarray) -> None:
        up, self._down = powers(len(names) + 1)
        self._sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * up[: len(names)], out=self._sums[1:])

    def all_of(self, length: int) -> np.ndarray:
        """A number for each stretch of a length: equal for equal stretches, in no meaningful order."""
        return (self._sums[length:] - self._sums[: len(self._sums) - length]) * self._down[: len(self._sums) - length]

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])


def runs(length: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A mask of 0..length-1 that is true inside any of the ranges."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned fingerprints as Spark's signed longs, same bits."""
    return values.view(np.int64)


def packed(raw: bytes) -> bytes:
    """A text made small for a shuffle; it starts with its length."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(stored: bytes) -> bytes:
    return pa.decompress(stored[8:], int.from_bytes(stored[:8], "little"), codec="zstd", asbytes=True)
