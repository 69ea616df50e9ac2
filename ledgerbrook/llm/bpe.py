"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of its bytes.  Each merge rank has a bucket of list positions whose
pair has that rank; a two-level bitmap tells which buckets have entries, so the lowest rank is
found by find-first-set.  An entry whose pair has changed meanwhile is stale
and skipped.  Work is about linear in the pre-token's length, also when it is very long.

The short pre-tokens that a task meets for the first time share one list and one queue: a step takes the
lowest rank and merges its leftmost valid entry in each of them, which for every pre-token is the
order it would have alone.

Inputs: any table; ``null`` text is an empty text, with no ids.  Rows, ties and repeated rows keep
their own result; an empty table gives an empty one.  Columns of the input with the same name
as a result column are replaced by it, all others are kept when ``keep`` names them.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices

# Pre-tokens up to this length are remembered by a task, and so many of them.
REMEMBERED_BYTES = 48
REMEMBERED = 500_000
# Bytes of text whose pre-tokens are looked up, and merged if new, at once.
SLICE_BYTES = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a blank, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """The merges of a vocabulary: pairs of ids, and the rank (the id) of what they become."""

    WORD = 1024  # ranks in one word of the lower bitmap level

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ids = [ranks.get(bytes([i]), -1) for i in range(256)]
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.found = np.array([self.pairs[key] for key in self.keys.tolist()], np.int64)
        self.words = max(ranks.values(), default=0) // self.WORD + 1
        self.bits = [1 << i for i in range(max(self.WORD, self.words))]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token.

        ``low`` and ``top`` are the two bitmap levels over the ranks; ``buckets`` holds the list
        positions of a rank.  A bucket is emptied from the left of the piece; it is sorted
        again when merges of other ranks have added to it.
        """
        find, bits = self.pairs.get, self.bits
        ids = list(map(self.ids.__getitem__, piece))
        size = len(ids)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        low, top = [0] * self.words, 0
        buckets: dict[int, list[int]] = {}
        added: set[int] = set()
        # From right to left, so that the end of a bucket is its leftmost position.
        for at in range(size - 2, -1, -1):
            rank = find(ids[at] << 32 | ids[at + 1])
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(at)
                else:
                    buckets[rank] = [at]
                    low[rank >> 10] |= bits[rank & 1023]
                    top |= bits[rank >> 10]
        while top:
            word = (top & -top).bit_length() - 1
            rank = word << 10 | (low[word] & -low[word]).bit_length() - 1
            bucket = buckets[rank]
            if rank in added:
                bucket.sort(reverse=True)
                added.discard(rank)
            at = bucket.pop()
            if not bucket:
                del buckets[rank]
                low[word] ^= bits[rank & 1023]
                if not low[word]:
                    top ^= bits[word]
            gone = after[at]
            left = ids[at]
            if left < 0 or gone >= size or find(left << 32 | ids[gone]) != rank:
                continue  # a stale entry
            ids[at] = rank
            ids[gone] = -1
            behind = after[gone]
            after[at] = behind
            last = before[at]
            if behind < size:
                before[behind] = at
                found = find(rank << 32 | ids[behind])
                if found is not None:
                    if found in buckets:
                        buckets[found].append(at)
                        added.add(found)
                    else:
                        buckets[found] = [at]
                        low[found >> 10] |= bits[found & 1023]
                        top |= bits[found >> 10]
            if last >= 0:
                found = find(ids[last] << 32 | rank)
                if found is not None:
                    if found in buckets:
                        buckets[found].append(last)
                        added.add(found)
                    else:
                        buckets[found] = [last]
                        low[found >> 10] |= bits[found & 1023]
                        top |= bits[found >> 10]
        return [i for i in ids if i >= 0]


    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, -1 where there is none; no pair has a negative id."""
        keys = (left << 32) | right
        at = self.keys.searchsorted(keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.found[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of many pre-tokens, none of them empty, as ``merge`` has them one by one."""
        if not len(self.keys):
            return [np.array(self.merge(piece)) for piece in pieces]
        sizes = np.array(list(map(len, pieces)))
        size = int(sizes.sum())
        ends = np.cumsum(sizes)
        # Position ``size`` stands for the end of a pre-token; it has no id.
        ids = np.append(np.array(self.ids)[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, size + 2), np.arange(-1, size)
        after[ends - 1] = size
        before[ends - sizes] = size
        low, top, bits = [0] * self.words, 0, self.bits
        buckets: dict[int, list[int]] = {}

        ranks = self._ranks(ids[:-1], ids[after[:-1]])
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        cuts = np.flatnonzero(np.diff(ranks[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            rank = int(ranks[part[0]])
            buckets[rank] = part.tolist()
            low[rank >> 10] |= bits[rank & 1023]
            top |= bits[rank >> 10]

        while top:
            word = (top & -top).bit_length() - 1
            rank = word << 10 | (low[word] & -low[word]).bit_length() - 1
            low[word] ^= bits[rank & 1023]
            if not low[word]:
                top ^= bits[word]
            at = np.array(buckets.pop(rank))
            at.sort()
            gone = after[at]
            valid = self._ranks(ids[at], ids[gone]) == rank  # the others are stale
            at, gone = at[valid], gone[valid]
            if not len(at):
                continue
            # The leftmost entry of each pre-token; the rest waits in the queue.
            of = piece[at]
            first = np.empty(len(at), bool)
            first[0] = True
            np.not_equal(of[1:], of[:-1], out=first[1:])
            waiting = at[~first]
            at, gone = at[first], gone[first]
            ids[at] = rank
            ids[gone] = -1
            behind = after[gone]
            after[at] = behind
            before[behind] = at
            last = before[at]
            merged = np.full(len(at), rank)
            near = np.concatenate([self._ranks(merged, ids[behind]), self._ranks(ids[last], merged)])
            where = np.concatenate([at, last])
            new = near >= 0
            pairs = zip(near[new].tolist(), where[new].tolist())
            if len(waiting):
                pairs = [*pairs, *((rank, position) for position in waiting.tolist())]
            for found, position in pairs:
                if found in buckets:
                    buckets[found].append(position)
                else:
                    buckets[found] = [position]
                    low[found >> 10] |= bits[found & 1023]
                    top |= bits[found >> 10]
        left = ids[:-1] >= 0
        cuts = np.cumsum(np.add.reduceat(left, ends - sizes))
        return np.split(ids[:-1][left], cuts[:-1])


def pack(ids: list[int] | np.ndarray) -> bytes:
    if isinstance(ids, np.ndarray):
        return ids.astype("<u4").tobytes()
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def unpack(packed: bytes) -> array:
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


class Encoder(dict):
    """Packed ids (little-endian, 32 bits) of pre-tokens, remembered while they are short."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.ranks = ranks
        self.merger = Merger(ranks)
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        packed = pack([whole] if whole is not None else self.merger.merge(raw))
        if len(raw) <= REMEMBERED_BYTES:
            self[piece] = packed
        return packed

    def learn(self, pieces: set[str]) -> None:
        """Remember the short ones among some pre-tokens that are new, merged all at once."""
        new = pieces.difference(self)
        if len(self) + len(new) > REMEMBERED:
            # What the last slice did not use goes.
            for piece in [piece for piece in self if piece not in pieces]:
                del self[piece]
        unmerged, raws = [], []
        for piece in new:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                self[piece] = pack([whole])
            elif len(raw) <= REMEMBERED_BYTES:
                unmerged.append(piece)
                raws.append(raw)
        if raws:
            self.update(zip(unmerged, map(pack, self.merger.merge_all(raws))))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        found = list(map(self.find, texts))
        self.learn(set().union(*found))
        return [b"".join(map(self.__getitem__, pieces)) for pieces in found]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, unpack(packed)))


# What an encoded row can hold: the type in Spark and in Arrow, and how it is made.
_RESULTS = {
    "n_tokens": ("bigint", pa.int64(), lambda packed, decoded: len(packed) // 4),
    "ids": ("array<int>", pa.list_(pa.int32()), lambda packed, decoded: unpack(packed)),
    "decoded": ("binary", pa.binary(), lambda packed, decoded: decoded),
    "ids_sha256": ("string", pa.string(), lambda packed, decoded: hashlib.sha256(packed).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda packed, decoded: hashlib.sha256(decoded).hexdigest()),
}


def encode(
    table: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    *,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    give: Sequence[str] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """Every text as token ids, and decoded again: the columns ``keep`` and those of ``give``.

    ``give`` names any of ``n_tokens``, ``ids``, ``decoded`` (bytes), and ``ids_sha256`` (of the
    ids as little-endian 32-bit numbers) and ``decoded_sha256``.  ``ranks`` is a vocabulary (a few
    megabytes whatever the table holds) and is broadcast.  Each row is encoded on its own: no
    shuffle.
    """
    shipped = table.sparkSession.sparkContext.broadcast((ranks, pattern))
    keep = [name for name in keep if name not in give]
    held = "text_" + "_" * max(map(len, keep), default=0)  # no kept column's name
    source = table.select(*[F.col(f"`{name}`") for name in keep], F.col(f"`{text}`").cast("string").alias(held))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]]
    fields += [f"{name} {_RESULTS[name][0]}" for name in give]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast object lives as long as the Python worker: later tasks find what is remembered.
        encoder = vars(shipped).setdefault("encoder", None)
        if encoder is None:
            encoder = shipped.encoder = Encoder(*shipped.value)
        for batch in slices(batches, held, SLICE_BYTES):
            made: list[list] = [[] for _ in give]
            texts = [value or "" for value in batch.column(batch.num_columns - 1).to_pylist()]
            for packed in encoder.encode_all(texts):
                decoded = encoder.decode(packed)
                for column, name in zip(made, give):
                    column.append(_RESULTS[name][2](packed, decoded))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(column, _RESULTS[name][1]) for column, name in zip(made, give)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *give])

    return source.mapInArrow(run, ", ".join(fields))
