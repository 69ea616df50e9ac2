"""Threshold-scaled sketches: of the hashes of a text's shingles, all that lie below a fixed fraction.

A shingle is ``SHINGLE`` consecutive code points (a shorter text is one shingle).  A hash is kept if it
is among the lowest ``1 / SCALE`` of all 48-bit numbers, whatever text it is from, so the sketch of a
union is the union of the sketches, and a short text can be looked for in a very long one: both keep
the same hashes of what they share.  So that short texts are not left with nothing, the ``LEAST``
smallest hashes are always kept; such a sketch is finer than the fixed fraction, and two sketches are
compared below the lower of their thresholds.  Unions of such sketches are exact, too.

A fingerprint is the kept hashes in ascending order, twelve hexadecimal digits each; that of an empty
text is empty.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Sequences, mix, packed, unpacked

SHINGLE = 12
SCALE = 32
LEAST = 64

_BITS = 48
_DIGITS = _BITS // 4
_THRESHOLD = (1 << _BITS) // SCALE
_ALL = 1 << _BITS


def sketch(text: str) -> np.ndarray:
    """The kept hashes of a text, ascending."""
    if not text:
        return np.zeros(0, np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sequence = Sequences(mix(points.astype(np.uint64) + np.uint64(1)))
    length = min(SHINGLE, len(points))
    # Mixed once more with the length: a text of one shingle is no part of a longer one.
    hashes = np.unique(mix(sequence.all_of(length) + np.uint64(length)) >> np.uint64(64 - _BITS))
    return _normal(hashes)


def _normal(hashes: np.ndarray) -> np.ndarray:
    return hashes[: max(LEAST, int(np.searchsorted(hashes, np.uint64(_THRESHOLD))))]


def to_text(kept: np.ndarray) -> str:
    return kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    low = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, _BITS // 8)
    return np.pad(low, ((0, 0), (2, 0))).view(">u8").ravel().astype(np.uint64)


def _below(kept: np.ndarray) -> int:
    """Below this number the sketch has all hashes of its text."""
    if len(kept) < LEAST:
        return _ALL
    return max(_THRESHOLD, int(kept[LEAST - 1]) + 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of the smaller shingle set that the larger one contains, 0 to 1.

    1 for two empty texts; 0 if one has no hash below the common threshold.
    """
    if not len(a) and not len(b):
        return 1.0
    below = np.uint64(min(_below(a), _below(b)))
    a, b = a[: np.searchsorted(a, below)], b[: np.searchsorted(b, below)]
    if not len(a) or not len(b):
        return 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` is empty."""
    below = np.uint64(min(_below(a), _below(b)))
    inner = a[: np.searchsorted(a, below)]
    if not len(inner):
        return 0.0 if len(a) else 1.0
    return float(np.isin(inner, b).mean())


def fingerprints(table: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the ``fingerprint`` of every whole text (null: empty).  One pass, no shuffle."""
    keep = [name for name in keep if name != "fingerprint"]
    held = "text_" + "_" * max(map(len, keep), default=0)  # no kept column's name
    source = table.select(*[F.col(f"`{name}`") for name in keep], F.col(f"`{text}`").cast("string").alias(held))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [to_text(sketch(value.as_py() or "")) for value in batch.column(batch.num_columns - 1)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], [*keep, "fingerprint"])

    return source.mapInArrow(run, ", ".join([*fields, "fingerprint string"]))


def merged(table: DataFrame, by: str, *, fingerprint: str = "fingerprint") -> DataFrame:
    """The fingerprint of all texts of a group taken together, from theirs alone: ``by, fingerprint``.

    Hashes that texts share meet before the shuffle.  A group ends as one value, which is its result:
    one in ``SCALE`` of its distinct shingles.
    """
    pieces = F.regexp_extract_all(F.col(f"`{fingerprint}`"), F.lit(f"(.{{{_DIGITS}}})"))
    hashes = table.select(F.col(f"`{by}`").alias("__by"), F.explode_outer(pieces).alias("__hash")).distinct()
    ordered = F.array_sort(F.collect_list("__hash"))
    low = F.filter(ordered, lambda h: h < F.lit(f"{_THRESHOLD:0{_DIGITS}x}"))
    kept = F.when(F.size(low) > LEAST, low).otherwise(F.slice(ordered, 1, LEAST))
    groups = hashes.groupBy("__by").agg(F.array_join(kept, "").alias("__kept"))
    return groups.select(F.col("__by").alias(by), F.col("__kept").alias("fingerprint"))


# Neighbours.  Ranges of documents per shuffle partition, and sampled documents per range.
RANGES = 4
SAMPLED = 40

_SENT = "part int, halo int, none int, down bigint, tie bigint, copies bigint, packed binary"
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _bounds(keys: DataFrame, first: tuple, total: int) -> list[tuple]:
    """Keys of documents that cut the order into ranges of about as many bytes, none of them the first.

    Of ``total`` documents a sample is looked at, whose size follows the number of ranges alone.
    """
    ranges = RANGES * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLED * ranges / max(total, 1))
    seen = sorted(tuple(row) for row in keys.sample(share, seed=1).collect())
    weight = np.cumsum([size + 64 for *_, size in seen])
    if not len(weight):
        return []
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges)
    return sorted({seen[i][:3] for i in cuts} - {first})


def edited(table: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    Documents stand in descending order of ``id`` (an integer; nulls last; equal ids in a fixed order by
    their texts, repeated rows next to each other), and the first follows the last.  The edited text has its last
    third (rounded down, in code points) replaced by as many code points from the start of the next
    document, or all it has.  A document alone is its own next.  A null text is empty; bytes that are no
    character count as U+FFFD.  Other columns are not looked at.

    Returns doc_id, n_chars, edited_sha256 (of the UTF-8 text), fingerprint, edited_fingerprint,
    near_edited and near_next (``likeness`` to the edited text's and to the next document's).

    Texts are shuffled once, compressed, by ranges of the order that a bounded sample finds; the document
    at the head of a range is sent to the range before, too.  A task walks through its ranges in order
    and holds two texts.  Copies of a row in one Arrow batch travel as one.
    """
    document = F.col(f"`{text}`").cast("string")
    number = F.col(f"`{id}`").cast("bigint")
    # Ascending (none, down, tie) is descending by id with nulls last.
    keyed = table.select(
        number.isNull().cast("int").alias("none"),
        F.coalesce(F.bitwise_not(number), F.lit(0)).alias("down"),
        F.xxhash64(document).alias("tie"),
        F.coalesce(document, F.lit("")).alias("text"),
    )
    keys = keyed.select("none", "down", "tie", F.octet_length("text").alias("size"))
    total, first = keys.agg(F.count("*"), F.min(F.struct("none", "down", "tie"))).head()
    first = tuple(first) if first else None
    bounds = table.sparkSession.sparkContext.broadcast(_bounds(keys, first, total))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = bounds.value
        names = ["part", "halo", "none", "down", "tie", "copies", "packed"]
        for batch in batches:
            rows: dict[tuple, list] = {}
            for *key, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if (key := tuple(key)) in rows:
                    rows[key][0] += 1
                else:
                    rows[key] = [1, packed(raw.as_py())]
            sent = []
            for key, (copies, stored) in rows.items():
                part = bisect_right(starts, key)
                sent.append((part, 0, *key, copies, stored))
                if part and starts[part - 1] == key:
                    sent.append((part - 1, 1, *key, 1, stored))
                if key == first:
                    sent.append((len(starts), 1, *key, 1, stored))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            for at in range(0, len(sent), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*sent[at : at + 1000]), kinds)], names
                )

    spread = keyed.select("none", "down", "tie", F.col("text").cast("binary")).mapInArrow(send, _SENT)
    order = ["part", "halo", "none", "down", "tie"]
    laid_out = spread.repartition("part").sortWithinPartitions(*order).select(*order, "copies", "packed")
    made = laid_out.mapInArrow(_walk, ", ".join(f"{f.name} {_SPARK[f.type]}" for f in _RESULT))
    return made.withColumnRenamed("doc_id", id)


_SPARK = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}


class _Text:
    """A document on the walk: its text and sketch."""

    def __init__(self, key: tuple, text: str) -> None:
        self.key, self.text, self.kept = key, text, sketch(text)
        self.shown = to_text(self.kept)

    def row(self, following: _Text) -> tuple:
        third = len(self.text) // 3
        changed = self.text[: len(self.text) - third] + following.text[:third]
        kept = self.kept if changed == self.text else sketch(changed)
        none, down, _ = self.key
        return (
            None if none else ~down,
            len(self.text),
            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            self.shown,
            to_text(kept),
            likeness(self.kept, kept),
            likeness(self.kept, following.kept),
        )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (range, halo last, key) to result rows; a range ends with the head of the next."""
    done: list[tuple] = []
    before: _Text | None = None
    part = None
    size = 0
    for batch in batches:
        for i in range(batch.num_rows):
            at, halo, *key, copies = (batch.column(c)[i].as_py() for c in range(6))
            if at != part:
                part, before = at, None
            if halo and before is None:
                continue  # the head of the next range is there already, or this range is empty
            now = _Text(tuple(key), unpacked(batch.column(6)[i].as_py()).decode("utf-8", "replace"))
            if before is not None:
                done.append(before.row(now))
            if copies > 1:
                done += [now.row(now)] * (copies - 1)
            before = None if halo else now
            size += len(now.shown)
            if len(done) >= 1000 or size > 1 << 22:
                yield _batch(done)
                done, size = [], 0
    if done:
        yield _batch(done)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RESULT)], schema=_RESULT)
