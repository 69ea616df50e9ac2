"""Similarity join of documents by their word n-grams, in the metric space of Jaccard distance.

1. Every text becomes the set of its distinct shingles.  Texts with the same set are one *node*.
2. Two sets of similarity ``t`` or more share one of the first ``n - ceil(t * n) + 1`` shingles of
   each, in any fixed order.  So the groups of nodes by such a shingle are *regions* that
   together hold every pair that can link.  The order puts shingles seen in many texts last:
   a passage that thousands of texts share makes a region only for texts that consist of it.
3. In each region its most central node (which lies in large regions otherwise, too) becomes
   *pivot*, and the exact distance of the others to it cuts the region.  With r = 1 - t, the
   nodes within r form the pivot's cell: they link with it and are one component already.  By
   the triangle inequality a node of the cell can link only with one within 2r of the pivot, so the
   nodes of that *window* are replicated: into the outer region with those beyond, and into an inner
   one with the cell.  Nodes of an inner region are told apart by how they differ from the
   pivot: |x ^ y| = |(x ^ p) ^ (y ^ p)|, so two that link share some of their differences,
   and the inner region is joined in the same way by these.
   A row carries the node's last ``EARLIER`` regions before its own, in the order of step 2, and the pivots of its first
   inner ones: two nodes that have one of these in common meet there and are no pair here, so that near
   copies do not meet in every region they share.  The pivots count from ``MANY`` pivots a region on: before, pairs would wait
   for a later round, and what they link would not be known.
   A region whose nodes are all one component is done.  In the others more nodes become pivots, more
   with each round; a pivot is compared with nodes of other components and leaves.  In regions of at most ``LEAF`` nodes all do so at once.  A pair is skipped where the
   shingles before the region's own leave too little to be common: if it links, it has an earlier common one.
4. Before two sets are compared, metrics that never exceed the size of their difference (of
   bucket counts of the shingles, and of the parities of ``ODD_BITS`` buckets) drop the pairs beyond 2r. The
   second is a condition of the join of a region's nodes with its pivots: no row is made of a pair that it tells apart.

The outcome is exact: no cap, no sampling.  What is broadcast are bitmaps of a fixed size that
only steer the order of shingles and the choice of texts to be read again.

Texts that are null or hold no word have an empty set and link with nothing; texts shorter than
a shingle are one shingle of all their words.  Repeated rows and texts link with each other.
A null id is ignored as the smallest id of its component.  Shingles and sets are compared by
64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import Sequences, mix, powers, signed, slices, texts_of, words_of
from .tables import bitmap, components, discard, in_bitmap, release, saved

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80

# A shingle that more sets have is put behind the others (where it was counted).
FREQUENT = 32
# What is counted: this share of a set's shingles, and all of a short text.
COUNTED_PERCENT, COUNTED_SHORT = 30, 128
# Bits of a shingle that tell in which piece it is counted.
PIECES = 12
# In regions up to this size every node becomes a pivot at once; in larger ones more with each round.
LEAF = 8
# Parities that a node carries into the later rounds.
ODD_BITS = 1024
FIRST_PIVOTS, MORE_PIVOTS = 2, 16
# How many regions before its own a row carries, and how many pivots of inner ones.
EARLIER = 8
MANY = 64


class Sets(NamedTuple):
    """The distinct shingles of some texts as 63-bit numbers: text i has names[first[i]:first[i + 1]], ascending."""

    names: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self) -> np.ndarray:
        """The text of each shingle."""
        return np.repeat(np.arange(len(self.first) - 1), self.sizes())

    def place(self) -> np.ndarray:
        """The place of each shingle in its set."""
        return np.arange(len(self.names)) - np.repeat(self.first[:-1], self.sizes())

    def prints(self) -> np.ndarray:
        """The fingerprint of each set; an empty one has none that counts."""
        sizes = self.sizes()
        up, _ = powers(int(sizes.max(initial=0)) + 1)
        sums = np.zeros(len(sizes), np.uint64)
        filled = np.flatnonzero(sizes)
        if len(filled):
            sums[filled] = np.add.reduceat(self.names * up[self.place()], self.first[filled])
        return signed(mix(sums))


def shingles(column: pa.Array, size: int) -> Sets:
    """The distinct shingles of each text; a text of fewer words is one."""
    words = words_of(texts_of(column), lower=True)
    sums = Sequences(words.hash)
    count = np.diff(words.first)
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    cuts = np.concatenate([[0], np.cumsum(number)])
    at = np.arange(cuts[-1]) + np.repeat(words.first[:-1] - cuts[:-1], number)
    names = sums.stretch(at, at + np.repeat(np.minimum(count, size), number)) >> np.uint64(1)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        names[low:high].sort()
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[cuts[:-1][number > 0]] = True
    return Sets(names[new], np.concatenate([[0], np.cumsum(new)])[cuts])


def _prefixes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles, in any fixed order, must hold one that a similar set has, too."""
    return np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)


def _sketches(sets: Sets, mixed: np.ndarray) -> pa.Array:
    """Counts of the shingles in a power of two of buckets, about as many as half the shingles."""
    sizes = sets.sizes()
    buckets = np.array([1 << max(3, (n - 1).bit_length() - 1) if n else 0 for n in sizes.tolist()], np.int64)
    first = np.concatenate([[0], np.cumsum(buckets)])
    text = sets.text()
    place = first[text] + (mixed & (buckets[text] - 1).astype(np.uint64)).astype(np.int64)
    count = np.minimum(np.bincount(place, minlength=first[-1]), 255).astype(np.uint8)
    made = pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(count)]
    )
    return pc.if_else(pa.array(sizes > 0), made, None)


def _odds(sets: Sets, mixed: np.ndarray) -> pa.Array:
    """The parity of the shingles in each bucket, as 64-bit numbers: a shingle that one of two sets lacks flips one bit."""
    sizes = sets.sizes()
    place = sets.text() * ODD_BITS + (mixed & np.uint64(ODD_BITS - 1)).astype(np.int64)
    count = np.bincount(place, minlength=len(sizes) * ODD_BITS)
    words = np.packbits((count & 1).astype(np.uint8), bitorder="little").view(np.int64)
    words = words.reshape(len(sizes), ODD_BITS // 64)[sizes > 0]
    return _lists(words.ravel(), np.where(sizes > 0, ODD_BITS // 64, 0), sizes > 0)


def _lists(values: np.ndarray, sizes: np.ndarray, filled: np.ndarray | None = None) -> pa.Array:
    """Lists of the given sizes; those that are not ``filled`` are null."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    made = pa.ListArray.from_arrays(offsets, pa.array(values))
    return made if filled is None else pc.if_else(pa.array(filled), made, None)


def _odds_apart(a: str, b: str) -> Column:
    """In how many parities two sets differ: at most the size of their symmetric difference."""
    parts = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(ODD_BITS // 64)]
    return reduce(add, parts)


def _ordered(sets: Sets, frequent: np.ndarray) -> np.ndarray:
    """Signed numbers, in each set in an order that has frequent shingles last."""
    hot = in_bitmap(frequent, sets.names >> np.uint64(31))
    cold = np.concatenate([[0], np.cumsum(~hot)])
    rank = cold[:-1] - np.repeat(cold[sets.first[:-1]], sets.sizes())  # cold ones before it in its set
    behind = np.repeat(np.diff(cold[sets.first]), sets.sizes()) + sets.place() - rank
    order = np.empty(len(hot), np.int64)
    order[np.repeat(sets.first[:-1], sets.sizes()) + np.where(hot, behind, rank)] = sets.names.view(np.int64) | np.where(
        hot, 0, np.int64(-(1 << 63))
    )
    return order


def _frequent(texts: DataFrame, size: int) -> np.ndarray:
    """A bitmap of the shingles that many sets have, among the first of each set.

    They are counted by 32 of their bits, in ``PIECES`` pieces: a task adds up what it has before it sends sorted arrays, and one
    piece at a time is added up behind the shuffle.  A count goes no further than ``FREQUENT`` and one.
    """
    most = FREQUENT + 1

    def added(place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(place, kind="stable")
        place = place[order]
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])[: len(place)])
        count = np.add.reduceat(count[order].astype(np.int64), cut) if len(cut) else count
        return place[cut], np.minimum(count, most)

    def pieces(parts: list[np.ndarray]) -> pa.RecordBatch:
        place = np.concatenate(parts)
        place.sort()
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])[: len(place)])
        count = np.minimum(np.diff(np.append(cut, len(place))), most).astype(np.uint8)
        place = place[cut]
        piece = place >> np.uint32(32 - PIECES)
        cut = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])[: len(piece)])
        ends = np.append(cut, len(piece)).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(piece[cut].astype(np.int32)),
                pa.array([place[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            ],
            names=["piece", "places", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in slices(batches, "text"):
            sets = shingles(batch.column(0), size)
            n = sets.sizes()
            taken = sets.place() < np.repeat(np.maximum(-(-COUNTED_PERCENT * n // 100), np.minimum(n, COUNTED_SHORT)), n)
            parts.append((sets.names[taken] >> np.uint64(31)).astype(np.uint32))
            waiting += len(parts[-1])
            if waiting > 1 << 21:
                yield pieces(parts)
                parts, waiting = [], 0
        if waiting:
            yield pieces(parts)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, waiting = None, [], 0

        def hot() -> pa.RecordBatch:
            place, count = added(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))
            return pa.RecordBatch.from_arrays([pa.array(place[count >= most].view(np.int32))], names=["place"])

        for batch in batches:
            for piece, places, counts in zip(*(batch.column(i) for i in range(3))):
                if own is not None and piece.as_py() != own:
                    yield hot()
                    parts, waiting = [], 0
                own = piece.as_py()
                parts.append((np.frombuffer(places.as_buffer(), np.uint32), np.frombuffer(counts.as_buffer(), np.uint8)))
                waiting += len(parts[-1][0])
                if waiting > 1 << 22:
                    parts = [added(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))]
                    waiting = 0
        if parts:
            yield hot()

    sent = texts.mapInArrow(run, "piece int, places binary, counts binary")
    counted = sent.repartition("piece").sortWithinPartitions("piece").mapInArrow(summed, "place int")
    return bitmap(counted, F.col("place").cast("bigint"))


def _sets(table: DataFrame, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document: id, node (fingerprint of the set), n, hash of the text, sketch, parities, prefix."""
    shipped = table.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(batch.column(1), size)
            n, mixed = sets.sizes(), mix(sets.names)
            first = _prefixes(n, percent)
            prefixes = _ordered(sets, shipped.value)[sets.place() < np.repeat(first, n)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sets.prints(), mask=n == 0),
                    pa.array(n),
                    _sketches(sets, mixed),
                    _odds(sets, mixed),
                    _lists(prefixes, first),
                ],
                names=["id", "text_hash", "node", "n", "sketch", "odd", "prefix"],
            )

    kind = table.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash bigint, node bigint, n bigint, sketch binary, odd array<bigint>, prefix array<bigint>"
    return table.select("id", "text", "text_hash").mapInArrow(run, schema)


def _whole_sets(texts: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """``node, names``: all shingles of the texts whose hash is in a bitmap."""
    shipped = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hit = in_bitmap(shipped.value, batch.column(1).to_numpy(zero_copy_only=False))
            sets = shingles(batch.column(0).filter(pa.array(hit)), size)
            n = sets.sizes()
            made = [pa.array(sets.prints()), _lists(signed(sets.names), n)]
            yield pa.RecordBatch.from_arrays(made, names=["node", "names"]).filter(pa.array(n > 0))

    return texts.mapInArrow(run, "node bigint, names array<bigint>").dropDuplicates(["node"])


def _coarse_apart(pairs: DataFrame) -> DataFrame:
    """The pairs whose bucket counts allow a distance within 2r, by numpy on each pair's two sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
            limit = batch.column("most").to_pylist()
            keep = []
            for a, b, most in zip(left, right, limit):
                a, b = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
                buckets = min(len(a), len(b))
                # Saturated counts would not add up, so only full ones are folded.
                if len(a) != len(b) and max(a.max(), b.max()) == 255:
                    keep.append(True)
                    continue
                a, b = a.reshape(-1, buckets).sum(axis=0), b.reshape(-1, buckets).sum(axis=0)
                keep.append(int(np.abs(a - b).sum()) <= most)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "n_a", "n_b"])

    return pairs.mapInArrow(run, "a bigint, b bigint, n_a bigint, n_b bigint")


def near_pairs(
    pairs: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int, least: int, give: Sequence[str]
) -> DataFrame:
    """Of the pairs ``a, b``, those of similarity ``least`` percent or more, written with the columns to ``give``.

    ``zone`` is 0 when they link, else 1; ``own`` and ``lacks`` are what only a and only b has.
    """
    side = {x: nodes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "sketch", "text_hash")]) for x in "ab"}
    sized = (
        pairs.join(side["a"], F.col("a") == F.col("node_a"))
        .join(side["b"], F.col("b") == F.col("node_b"))
        .where(100 * F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b"))
        # |x ^ y| <= (1 - j) / (1 + j) * (|x| + |y|)
        .withColumn("most", F.expr(f"(n_a + n_b) * {100 - least} div {100 + least}"))
    )
    close = saved(_coarse_apart(sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "most")), "close")
    ends = close.select(F.col("a").alias("node")).union(close.select(F.col("b").alias("node"))).distinct()
    wanted = bitmap(ends.join(nodes, "node").select("text_hash"), F.col("text_hash"))
    sets = saved(_whole_sets(texts, size, wanted).join(ends, "node", "left_semi"), "sets")
    own, lacks = F.array_except("names_a", "names_b"), F.array_except("names_b", "names_a")
    found = (
        close.join(sets.select(F.col("node").alias("a"), F.col("names").alias("names_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("names").alias("names_b")), "b")
        .select("a", "b", "n_a", "n_b", F.array_sort(own).alias("own"), F.array_sort(lacks).alias("lacks"))
        .withColumn("common", F.col("n_a") - F.size("own"))
    )
    similar = lambda least: 100 * F.col("common") >= least * (F.col("n_a") + F.size("lacks"))
    zone = F.when(similar(percent), 0).otherwise(1).alias("zone")
    near = saved(found.where(similar(least)).select("a", "b", zone, "own", "lacks").select(*give), "near")
    discard(close)
    discard(sets)
    return near


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (``node, component``) with more links: only these, seen between components, are followed."""
    of = found.select(F.col("node").alias("of"), "component")
    ends = {}
    for side in "ab":
        links = links.join(of, F.col(side) == F.col("of"), "left").withColumn(f"{side}_in", F.coalesce("component", side))
        links = links.drop("of", "component")
        ends[side] = F.col(f"{side}_in").alias(side)
    merged = components(saved(links.select(*ends.values()).where("a <> b").distinct(), "links"))
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return saved(old.unionByName(merged.join(found, "node", "left_anti")), "components")


def _met(rows: DataFrame, pivots: DataFrame, percent: int, inside: bool) -> DataFrame:
    """The pairs ``a, b`` of a region's nodes and its pivots that may link and do not meet in an earlier region."""
    # A pair that can link can do so with the rest from its first common shingle on.
    enough = 2 * (100 + percent) * F.least("rest", "pivot_rest") >= (100 + percent) * (
        F.col("size") + F.col("pivot_size")
    ) - (100 - percent) * (F.col("n") + F.col("pivot_n"))
    apart = (F.col("c") != F.col("pivot_c")) & (F.greatest("zone", "pivot_zone") == 2)
    most = F.expr(f"(n + pivot_n) * {100 - percent} div {100 + percent}")
    alike = _odds_apart("odd", "pivot_odd") <= most
    first = ~F.arrays_overlap("before", "pivot_before")
    if inside:
        first &= ~F.arrays_overlap("outside", "pivot_outside")
    ends = [F.least("node", "pivot_node").alias("a"), F.greatest("node", "pivot_node").alias("b")]
    return rows.join(pivots, "region").where(apart & enough & alike & first).select(*ends)


def _links(texts: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, component`` of all nodes that link with another."""
    release(sets.sparkSession)
    filled = sets.where("n > 0")
    nodes = filled.groupBy("node").agg(*[F.min(c).alias(c) for c in ("n", "sketch", "text_hash", "odd")])
    nodes = saved(nodes, "nodes")
    rows = filled.select("node", "n", "prefix").dropDuplicates(["node"])
    rows = rows.select("node", "n", F.posexplode("prefix").alias("at", "region"))
    # What a set has from this shingle on: all that can be common if it is the first common one.
    rows = rows.select("region", "node", (F.col("n") - F.col("at")).cast("int").alias("rest"))
    rows = rows.select("*", F.count("*").over(Window.partitionBy("region")).alias("m")).where("m > 1")
    rows = saved(rows, "regions")
    # The original of many near copies lies in larger regions than they do, who have parts of their own.
    central = rows.groupBy("node").agg(F.avg("m").alias("central")).join(nodes.select("node", "n", "odd"), "node")
    central = saved(central, "central")
    release(sets.sparkSession)
    placed = rows.select("region", "node", "rest").join(central.select("node", "central"), "node")
    unplaced = rows
    middle = placed.groupBy("region").agg(F.max_by("node", F.struct("central", "node")).alias("pivot"))
    rows = saved(rows.join(middle, "region").select("region", "node", "rest", "pivot"), "regions")
    discard(unplaced)
    pairs = rows.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    asked = pairs = saved(pairs.distinct(), "pairs")
    near = near_pairs(
        pairs, nodes, texts, size, percent, max(2 * percent - 100, 1), ["a", "b", "zone", "own", "lacks"]
    )
    links = near.where("zone = 0").select("a", "b")
    found = components(links)

    # What the next round's rows are made from, and what goes once they are written.
    behind = [rows, near]
    # Within 2r of a pivot: regions by the shingles in which a set and the pivot differ.
    windows = near.where("zone = 1").select("b").distinct()
    apart = near.join(windows, "b", "left_semi").join(central.select(F.col("node").alias("a"), "n"), "a")
    length = F.size("own") + F.size("lacks")
    most = F.expr(f"n * (100 + {percent}) * (100 - {percent}) div ({percent} * (100 + {percent})) + 1")
    first = F.slice(F.concat("own", "lacks"), 1, F.least(length, most.cast("int")))
    inner = apart.select(F.col("a").alias("node"), "b", length.alias("size"), F.posexplode(first).alias("at", "name"))
    inner = inner.select(
        F.xxhash64("b", "name").alias("region"), "node", "size", (F.col("size") - F.col("at")).alias("rest"),
        F.lit(2).alias("zone"), F.col("b").alias("inside"),
    )
    # Beyond: the regions as they were, for pairs of which one is not within 2r.
    zones = near.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "zone")
    outer = rows.where("node <> pivot").join(zones, ["node", "pivot"], "left")
    outer = outer.select("region", "node", "rest", F.coalesce("zone", F.lit(2)).alias("zone")).where("zone > 0")
    outer = outer.join(central.select("node", F.col("n").cast("int").alias("size")), "node")
    rows = inner.unionByName(outer.withColumn("inside", F.lit(None).cast("bigint")))
    # Two nodes with a pivot in common are decided inside it, and outside only if they have none.  Among regions of one pivot, or
    # the outer ones where both are beyond the window, the first they share holds the pair until it is compared or one
    # component; what leaves enough to be common in a later one does so there.
    pivots = apart.groupBy(F.col("a").alias("node")).agg(F.sort_array(F.collect_set("b")).alias("pivots"))
    rows = rows.join(pivots.withColumn("pivots", F.slice("pivots", 1, EARLIER)), "node", "left")
    outside = F.expr("filter(coalesce(pivots, array()), b -> inside is null or b < inside)")
    earlier = Window.partitionBy("node", "inside").orderBy(F.desc("rest")).rowsBetween(-EARLIER, -1)
    regions = F.collect_list(F.when(F.col("zone") == 2, F.col("region"))).over(earlier)
    rows = rows.withColumn("before", regions).withColumn("outside", outside).drop("inside", "pivots")
    many, region = FIRST_PIVOTS, Window.partitionBy("region")
    while True:
        rows = rows.join(found, "node", "left").join(central, "node")
        rows = rows.withColumn("c", F.coalesce("component", "node")).select(
            "*", F.min("c").over(region).alias("low"), F.max("c").over(region).alias("high"),
            F.max("zone").over(region).alias("far"), F.count("*").over(region).alias("m"),
        ).where("low < high and far = 2")
        number = F.row_number().over(region.orderBy(F.desc("central"), "node"))
        kept = ("node", "size", "rest", "zone", "n", "c", "odd", "before", "outside")
        rows = saved(rows.select("region", *kept, "m", number.alias("k")), "rest")
        for table in behind:
            discard(table)
        behind = [rows]
        release(sets.sparkSession)
        if rows.isEmpty():
            for table in (nodes, central):
                discard(table)
            return found
        chosen = (F.col("k") <= many) | (F.col("m") <= LEAF)
        pivots = rows.where(chosen).select("region", *[F.col(x).alias(f"pivot_{x}") for x in kept])
        pairs = _met(rows, pivots, percent, many > MANY).distinct()
        done = asked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = saved(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            asked = done.unionByName(pairs)
            near = near_pairs(pairs, nodes, texts, size, percent, percent, ["a", "b"])
            found = _joined(found, near)
        rows = rows.where(~chosen).select("region", "node", "size", "rest", "zone", "before", "outside")
        many *= MORE_PIVOTS


def jaccard_components(
    table: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similar_percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id that links lead to.

    Documents link when 100 * |intersection| >= similar_percent * |union| of their shingles.
    """
    texts = table.select(
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{text}`").cast("binary").alias("text"),
        F.xxhash64(F.col(f"`{text}`").cast("binary")).alias("text_hash"),
    )
    frequent = _frequent(texts.select("text"), shingle_words)
    sets = saved(_sets(texts, shingle_words, similar_percent, frequent), "sets")
    found = _links(texts.select("text", "text_hash"), sets, shingle_words, similar_percent)
    documents = sets.select("id", "n", "node").join(found, "node", "left")
    documents = saved(documents.select("id", "n", F.coalesce("component", "node").alias("component")), "documents")
    discard(sets)
    release(table.sparkSession)
    smallest = documents.groupBy("component").agg(F.min("id").alias("smallest"))
    joined = documents.join(smallest, "component", "left")
    return joined.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
    )
