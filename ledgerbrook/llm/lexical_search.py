"""Ranked lexical search: the best documents of every query by an integer BM25, through norm buckets.

A document is a vector with one impact per term, a query a vector with one weight per term, and the
score their product.  Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``,
A-Z lower-cased.  Impacts, weights and scores are the integers of ``impacts`` and ``weights``.

Queries come in blocks of bounded size.  For a block, one pass over the texts keeps each document's
terms that any of its queries has; counts over these vectors give the weights.  Vectors are then
searched from the longest to the shortest, as in LEMP: a task orders its vectors by length and cuts
them into buckets.

- A bucket whose longest vector times the query's length (Cauchy-Schwarz) stays under the query's
  threshold, the score of its 50th document so far, ends the query: later buckets are shorter.
- In a bucket, the product over the query's few largest coordinates plus the product of the remaining
  lengths bounds each score; only what reaches the threshold is scored, in integers.

The longest vectors of the whole table are searched first (``WAVES``).  Their thresholds go into the
search of the others, so that those tasks start with them and give only what can still be in the list.
Bounds are raised by more than a rounding error, so nothing is lost: the result is that of scoring all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import saved

# A block of queries ends with this many, or with so many terms, whichever comes first.
BLOCK_QUERIES = 4096
BLOCK_TERMS = 1 << 18

# Vectors that a task holds and orders at once, and their entries; vectors of a bucket.
HELD_VECTORS = 1 << 15
HELD_ENTRIES = 1 << 22
BUCKET = 1024

# Coordinates of a query that bound a score before it is computed.
FOCUS = 4

# Shares of the vectors, by length, after which the thresholds are settled among all tasks.
WAVES = (1 / 32,)

# Rows of a query are cut within so many hash buckets first.
SPREAD = 32

# Float bounds are raised by this share, far more than the rounding error of their few operations.
_SLACK = 1 + 1e-9

_TERMS = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TERMS[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TERMS[_c] = _c + 32
_TERMS = bytes(_TERMS)


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return raw.translate(_TERMS).split()


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The impact of a term that occurs tf times in a document of n terms."""
    m = 100 - 50 + (50 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block(NamedTuple):
    """Some queries: their ids as given, and the places of their terms in the block's vocabulary."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def _blocks(queries: DataFrame, id: str, text: str) -> Iterator[Block]:
    """The queries, read partition by partition, in blocks that fit the driver and a broadcast."""
    source = queries.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    block, held = Block([], [], {}), 0
    for row in source.toLocalIterator():
        found = dict.fromkeys(terms_of(bytes(row.text or b"")))
        if not found:
            continue
        if block.ids and (len(block.ids) >= BLOCK_QUERIES or held + len(found) > BLOCK_TERMS):
            yield block
            block, held = Block([], [], {}), 0
        block.ids.append(row.id)
        places = [block.vocabulary.setdefault(term, len(block.vocabulary)) for term in found]
        block.terms.append(np.array(sorted(places), np.int64))
        held += len(found)
    if block.ids:
        yield block


_VECTORS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]
)


def _vectors(documents: DataFrame, id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Of every document with a term: its number of terms, and those of the vocabulary with counts."""
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)
    number, document = F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`").cast("string").cast("binary")
    source = documents.select(number.alias("doc_id"), document.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shipped.value.get
        for batch in batches:
            ids, ns, ats, tfs = [], [], [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(raw.as_py() or b"")
                if terms:
                    known = np.array([p for p in map(place, terms) if p is not None], np.int32)
                    at, tf = np.unique(known, return_counts=True)
                    ids.append(doc_id)
                    ns.append(len(terms))
                    ats.append(at)
                    tfs.append(tf.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip((ids, ns, ats, tfs), _VECTORS)], schema=_VECTORS
            )

    return source.mapInArrow(run, "doc_id bigint, n bigint, at array<int>, tf array<bigint>")


class Vectors:
    """Document vectors by descending length, in rows and, per bucket, in columns."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """Row i has value[starts[i]:starts[i + 1]] at the places ``at``; no row is without any."""
        squares = np.add.reduceat(value.astype(np.float64) ** 2, starts[:-1])
        order = np.argsort(-squares, kind="stable")
        sizes = np.diff(starts)[order]
        self.ids, self.squares = ids[order], squares[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.arange(self.starts[-1]) - np.repeat(self.starts[:-1], sizes) + np.repeat(starts[:-1][order], sizes)
        self.at, self.value = at[taken], value[taken]
        self.row = np.repeat(np.arange(len(sizes)), sizes)

    def bucket(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries of rows low..high-1 ordered by place: places, rows from 0, values."""
        part = slice(self.starts[low], self.starts[high])
        order = np.argsort(self.at[part], kind="stable")
        return self.at[part][order], self.row[part][order] - low, self.value[part][order]


class Lists:
    """The best documents of each query so far: scores, highest first, equal scores by ascending id."""

    def __init__(self, best: int, floors: np.ndarray) -> None:
        self.best = best
        self.thresholds = floors.copy()  # a score below this is not among the best
        self.scores = [np.zeros(0, np.int64) for _ in floors]
        self.ids = [np.zeros(0, np.int64) for _ in floors]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= max(1, self.thresholds[query])
        scores = np.concatenate([self.scores[query], scores[keep]])
        ids = np.concatenate([self.ids[query], ids[keep]])
        order = np.lexsort((ids, -scores))[: self.best]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        if len(order) == self.best:
            self.thresholds[query] = max(self.thresholds[query], int(scores[order[-1]]))


class Queries:
    """Query vectors: dense weights on demand, lengths, and the focus coordinates."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray) -> None:
        self.terms, self.weights, self.dense = terms, weights, np.zeros(len(weights), np.int64)
        self.lengths = np.array([np.sqrt((weights[t].astype(np.float64) ** 2).sum()) for t in terms])
        self.focus, self.rest = [], np.zeros(len(terms))
        for i, t in enumerate(terms):
            by_weight = t[np.argsort(-weights[t], kind="stable")]
            self.focus.append(by_weight[:FOCUS])
            self.rest[i] = np.sqrt((weights[by_weight[FOCUS:]].astype(np.float64) ** 2).sum())


def search(vectors: Vectors, queries: Queries, lists: Lists) -> None:
    """Add the best of the vectors to the lists, bucket after bucket while a query can still gain."""
    live = np.arange(len(queries.terms))
    for low in range(0, len(vectors.ids), BUCKET):
        high = min(low + BUCKET, len(vectors.ids))
        longest = math.sqrt(vectors.squares[low])
        live = live[queries.lengths[live] * longest * _SLACK >= lists.thresholds[live]]
        if not len(live):
            return
        places, rows, values = vectors.bucket(low, high)
        squares = vectors.squares[low:high]
        for q in live:
            product, seen = np.zeros(high - low), np.zeros(high - low)
            for place in queries.focus[q]:
                part = slice(*np.searchsorted(places, (place, place + 1)))
                product[rows[part]] += float(queries.weights[place]) * values[part]
                seen[rows[part]] += values[part].astype(np.float64) ** 2
            # The slack on the squares keeps a remainder that rounding would lose.
            bound = product + queries.rest[q] * np.sqrt(np.maximum(squares * _SLACK - seen, 0))
            hopeful = np.flatnonzero((bound * _SLACK >= lists.thresholds[q]) & (bound > 0))
            if len(hopeful):
                _rescore(vectors, queries, lists, q, low + hopeful)


def _rescore(vectors: Vectors, queries: Queries, lists: Lists, q: int, chosen: np.ndarray) -> None:
    """The exact scores of some vectors, in integers."""
    sizes = vectors.starts[chosen + 1] - vectors.starts[chosen]
    first = np.concatenate([[0], np.cumsum(sizes)])
    entries = np.arange(first[-1]) - np.repeat(first[:-1], sizes) + np.repeat(vectors.starts[chosen], sizes)
    queries.dense[queries.terms[q]] = queries.weights[queries.terms[q]]
    scores = np.add.reduceat(queries.dense[vectors.at[entries]] * vectors.value[entries], first[:-1])
    queries.dense[queries.terms[q]] = 0
    lists.add(q, scores, vectors.ids[chosen])


# A document without an id comes after all that have one.
_NO_ID = np.iinfo(np.int64).max


def _searched(vectors: DataFrame, shipped, best: int) -> DataFrame:
    """Per task the best documents of each query: ``query, doc_id, score``, ids as in ``_NO_ID``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, floors, documents, total = shipped.value
        queries, lists = Queries(terms, weights), Lists(best, floors)
        held, rows, entries = [], 0, 0

        def flush() -> None:
            nonlocal held, rows, entries
            if rows:
                at = pa.chunked_array([b.column("at") for b in held]).combine_chunks()
                tf = pa.chunked_array([b.column("tf") for b in held]).combine_chunks()
                starts = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy())])
                ids = np.concatenate([b.column("doc_id").fill_null(_NO_ID).to_numpy() for b in held])
                n = np.concatenate([b.column("n").to_numpy() for b in held])
                value = impacts(tf.flatten().to_numpy(), np.repeat(n, np.diff(starts)), documents, total)
                search(Vectors(ids, starts, at.flatten().to_numpy().astype(np.int64), value), queries, lists)
            held, rows, entries = [], 0, 0

        for batch in batches:
            for low in range(0, batch.num_rows, BUCKET):
                part = batch.slice(low, BUCKET)
                held.append(part)
                rows += part.num_rows
                entries += len(part.column("at").flatten())
                if rows >= HELD_VECTORS or entries >= HELD_ENTRIES:
                    flush()
        flush()
        for q, (scores, ids) in enumerate(zip(lists.scores, lists.ids)):
            if len(scores):
                columns = [np.full(len(scores), q, np.int32), ids, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "doc_id", "score"])

    return vectors.mapInArrow(run, "query int, doc_id bigint, score bigint")


def _best(hits: DataFrame, best: int) -> DataFrame:
    """The best hits of each query with their ``rank``, cut within hash buckets first."""
    order = [F.desc("score"), F.asc("doc_id")]
    spread = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))).orderBy(*order)
    cut = hits.withColumn("rank", F.row_number().over(spread)).where(F.col("rank") <= best)
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= best)


def _length(documents: int, total: int) -> Column:
    """The squared length of a vector."""
    m = F.expr(f"{100 - 50} + (50 * n * {documents}L) div {total}L")
    value = F.transform(
        "tf", lambda tf: F.pow(F.floor(F.lit(1_000_000_000.0) * tf / (F.lit(1000) * tf + F.lit(20) * m)), F.lit(2.0))
    )
    return F.aggregate(value, F.lit(0.0), lambda a, b: a + b)


def _block_hits(documents: DataFrame, block: Block, id: str, text: str, best: int) -> DataFrame:
    spark = documents.sparkSession
    vectors = saved(_vectors(documents, id, text, block.vocabulary), "vectors")
    count, total = vectors.agg(F.count("*"), F.sum("n")).head()
    if not count:
        return spark.createDataFrame([], "query int, doc_id bigint, score bigint, rank int")
    # As many rows as the block has terms.
    frequencies = vectors.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("df")).toArrow()
    weights = np.full(len(block.vocabulary), weight(0, count), np.int64)
    for at, df in zip(frequencies["at"].to_pylist(), frequencies["df"].to_pylist()):
        weights[at] = weight(df, count)

    some = vectors.where(F.size("at") > 0).withColumn("length", _length(count, total))
    limits = some.agg(F.percentile_approx("length", [1 - share for share in WAVES], 1000)).head()[0] or []
    floors, found, above = np.zeros(len(block.ids), np.int64), [], None
    for limit in [*limits, None]:
        wave = some if limit is None else some.where(F.col("length") >= limit)
        wave = wave if above is None else wave.where(F.col("length") < above)
        shipped = spark.sparkContext.broadcast((block.terms, weights, floors, count, total))
        found.append(_searched(wave.drop("length"), shipped, best))
        hits = _best(found[0] if len(found) == 1 else found[0].unionByName(found[1]), best)
        hits = saved(hits, "hits")
        found, above = [hits.drop("rank")], limit
        if limit is not None:
            last = hits.where(F.col("rank") == best).select("query", "score").toArrow()
            floors = floors.copy()
            floors[last["query"].to_numpy()] = last["score"].to_numpy()
    return hits


def top_documents(
    documents: DataFrame,
    queries: DataFrame,
    *,
    best: int = 50,
    id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """The ``best`` highest-scoring documents of every query: query_id, rank, doc_id, score.

    Only scores above 0 count; equal scores go by ascending document id (an integer), a missing id last.
    A null text has no terms; a document or query without terms is in no row.  Every row of either
    table stands for itself, repeated rows too.  Empty tables give no rows.  Other columns are not looked at.

    Each block of queries reads the texts once.  What a task holds is bounded by ``HELD_VECTORS`` and
    ``HELD_ENTRIES`` and by ``best`` rows a query; what the driver holds, by the block.
    """
    spark = documents.sparkSession
    kind = queries.schema[query_id].dataType
    schema = f"query int, `{query_id}` {kind.simpleString()}"
    parts = []
    for block in _blocks(queries, query_id, query_text):
        names = spark.createDataFrame(list(enumerate(block.ids)), schema)
        hits = _block_hits(documents, block, id, text, best)
        # As many rows as the block has queries.
        parts.append(hits.join(F.broadcast(names), "query"))
    shown = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias(id)
    if not parts:
        schema = f"`{query_id}` {kind.simpleString()}, rank int, `{id}` bigint, score bigint"
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(f"`{query_id}`", "rank", shown, "score")
