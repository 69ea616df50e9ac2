"""The prefix trie of conversations, from vertical bitmaps.

A shard is a run of conversations in ascending order.  It is indexed by (position, turn): a bitset
with one bit per conversation that has this turn there.  The walk goes depth first: the
intersection of a node's bitset with the posting of a next turn is a child, its popcount the members
in the shard, and its intersection with the bitset of conversations that end here the node's end list.
Only postings that meet the node are looked up: those of the lowest member that no child has yet.

Shards are merged by node.  A node is named by 128 bits that are the exclusive or of one hash per
(position, turn) of its path.  What depends on the whole trie (leaves, saved tokens) is summed over
conversations instead of levels: the node of a smallest member c is owned by c, so a subtree's sum is
the sum of what all members own, less what the node's owner owns above it.  A second walk adds up the members'
sums.  So the number of Spark jobs does not follow the depth of the trie.

Conversations longer than ``BLOCK`` turns are cut into blocks of positions, each of which starts
from the name of its prefix, so neither a long conversation nor a hot prefix is one task's work.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import rank_in_groups
from .tables import saved

# Positions of a block; turns and pieces (blocks of conversations) after which a shard ends.
BLOCK = 1024
SHARD_TURNS = 1 << 15
SHARD_PIECES = 2048

WORD = r"[^\x20\x09-\x0D]+"


def turn_name(role: str, text: str) -> Column:
    """MD5 of a turn, as hexadecimal digits: what makes two turns equal, and the order of equal turn numbers."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)))


def ordered_turns(
    table: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, position, name, words``: the turns of each conversation numbered from 1.

    They are ordered by turn, null first, and turns of one number by ``turn_name``; repeated rows
    stay.  A null role or text is empty.  Rows without a conversation are left out.
    """
    columns = {"conv_id": id, "turn": turn, "role": role, "text": text}
    rows = table.select(*[F.col(f"`{name}`").alias(new) for new, name in columns.items()])
    rows = rows.where("conv_id is not null").fillna("", ["role", "text"])
    # The row's number splits rows that are equal in all else.
    named = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        turn_name("role", "text").alias("name"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.asc("name"), F.asc("row")]
    return rank_in_groups(named, "conv_id", order, rank="position").select("conv_id", "position", "name", "words")


def rebuilt(turns: DataFrame, *, family: int = 20, most: int = 4) -> DataFrame:
    """Conversations that start with turns of their family's first one: ``conv_id, position, name, words, n_turns``.

    Conversation c takes the first h turns of c - c % family (all if it has fewer, none if it is not
    there) and then its own turns after its first h; h is crc32 of the decimal c, modulo ``most``.
    One more row per conversation, at position 0, has neither name nor words.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = F.col("conv_id") - F.col("conv_id") % family
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    sizes = sizes.withColumns({"head": head, "h": share})
    heads = sizes.where("conv_id = head").select("head", F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    plan = sizes.join(heads, "head", "left").select(
        "conv_id", "head", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")
    )
    plan = saved(plan, "plan")
    own = turns.join(plan, "conv_id").where("position > h")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "name", "words", "n_turns")
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("position") < most))
    first = first.select(F.col("conv_id").alias("head"), "position", "name", "words")
    borrowed = plan.where("taken > 0").join(first, "head").where("position <= taken")
    opening = plan.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("position"),
        F.lit(None).cast("string").alias("name"),
        F.lit(0).cast("bigint").alias("words"),
        "n_turns",
    )
    return own.unionByName(borrowed.select(*own.columns)).unionByName(opening)


def _pieces(turns: DataFrame) -> DataFrame:
    """Turns with the two halves of their hash, and an opening row per block with the name of its prefix.

    ``open`` rows stand at the position before the block; ``last`` marks where a conversation ends.
    """
    steps = turns.where("position > 0").select(
        "conv_id",
        F.floor((F.col("position") - 1) / BLOCK).alias("block"),
        "position",
        F.xxhash64("position", "name").alias("h1"),
        F.xxhash64("name", "position", F.lit(1)).alias("h2"),
        "words",
        (F.col("position") == F.col("n_turns")).alias("last"),
        F.lit(False).alias("open"),
    )
    # One row per block of a conversation.
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = steps.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    later = whole.select(
        "conv_id", "block", F.bit_xor("x1").over(earlier).alias("h1"), F.bit_xor("x2").over(earlier).alias("h2")
    ).where("block > 0")
    later = later.select(
        "conv_id", "block", (F.col("block") * BLOCK).alias("position"), "h1", "h2",
        F.lit(0).cast("bigint").alias("words"), F.lit(False).alias("last"), F.lit(True).alias("open"),
    )
    zero = F.lit(0).cast("bigint")
    roots = turns.where("position = 0").select(
        "conv_id", zero.alias("block"), "position", zero.alias("h1"), zero.alias("h2"),
        "words", (F.col("n_turns") == 0).alias("last"), F.lit(True).alias("open"),
    )
    return steps.unionByName(later).unionByName(roots)


class Shard:
    """Pieces of conversations in ascending order, and their index by (position, turn)."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.depth: list[int] = []
        self.turns: list[list[tuple]] = []
        self.sums: list[tuple] = []
        self.starts: dict[tuple, int] = defaultdict(int)
        self.postings: dict[tuple, int] = defaultdict(int)
        self.ends: dict[int, int] = defaultdict(int)
        self.words: dict[tuple, int] = {}
        self.rows = 0

    def open(self, id: int, depth: int, name: tuple, last: bool, sums: tuple) -> None:
        bit = 1 << len(self.ids)
        self.ids.append(id)
        self.depth.append(depth)
        self.turns.append([])
        self.sums.append(sums)
        self.starts[(depth, *name)] |= bit
        if last:
            self.ends[depth] |= bit
        self.rows += 1

    def add(self, turn: tuple, words: int, last: bool) -> None:
        """The next turn of the piece opened last; ``turn`` is hashed with its position."""
        bit = 1 << (len(self.ids) - 1)
        self.turns[-1].append(turn)
        position = self.depth[-1] + len(self.turns[-1])
        self.postings[(position, turn)] |= bit
        self.words[turn] = words
        if last:
            self.ends[position] |= bit
        self.rows += 1

    def nodes(self) -> Iterator[tuple]:
        """Depth first: (name, depth, parent's name, words of the last turn, members), the root included."""
        following = defaultdict(int)  # by position: the pieces that have a turn there
        for (position, _), members in self.postings.items():
            following[position] |= members
        for (depth, *name), members in self.starts.items():
            if depth == 0:
                yield (0, 0), 0, (None, None), 0, members
            stack = [(depth, tuple(name), members)]
            while stack:
                depth, name, members = stack.pop()
                left = members & following.get(depth + 1, 0)
                while left:
                    lowest = (left & -left).bit_length() - 1
                    turn = self.turns[lowest][depth - self.depth[lowest]]
                    child = members & self.postings[(depth + 1, turn)]
                    left &= ~child
                    below = (name[0] ^ turn[0], name[1] ^ turn[1])
                    yield below, depth + 1, name, self.words[turn], child
                    stack.append((depth + 1, below, child))

    def places(self, members: int) -> np.ndarray:
        """The pieces of a bitset, ascending."""
        if members & (members - 1) == 0:
            return np.array([members.bit_length() - 1] if members else [], np.int64)
        raw = np.frombuffer(members.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


_COUNTED = pa.schema(
    [
        *[(name, pa.int64()) for name in ("n1", "n2", "depth", "p1", "p2", "words", "conv_id", "members", "first_end")],
        ("ends", pa.binary()),
    ]
)
_SUMMED = pa.schema([(name, pa.int64()) for name in ("n1", "n2", "leaves", "saved")])


def _counted(shard: Shard) -> Iterator[tuple]:
    ids = np.array(shard.ids, np.int64)
    for name, depth, parent, words, members in shard.nodes():
        ending = members & shard.ends.get(depth, 0)
        ends = ids[shard.places(ending)] if ending else None
        lowest = (members & -members).bit_length() - 1
        first, raw = (None, None) if ends is None else (int(ends[0]), ends.tobytes())
        yield (*name, depth, *parent, words, shard.ids[lowest], members.bit_count(), first, raw)


def _summed(shard: Shard) -> Iterator[tuple]:
    leaves, kept = (np.array(column, np.int64) for column in zip(*shard.sums))
    for name, _, _, _, members in shard.nodes():
        at = shard.places(members)
        yield (*name, int(leaves[at].sum()), int(kept[at].sum()))


def _walked(pieces: DataFrame, give, schema: pa.Schema) -> DataFrame:
    """Shards cut from the sorted pieces, each walked for itself.  ``pieces`` has ``leaves`` and ``saved`` of each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(shard: Shard) -> Iterator[pa.RecordBatch]:
            rows = []
            for row in give(shard):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        shard = Shard()
        for batch in batches:
            for id, _, position, h1, h2, words, last, open, leaves, kept in zip(*(c.to_pylist() for c in batch.columns)):
                if open:
                    if shard.rows >= SHARD_TURNS or len(shard.ids) >= SHARD_PIECES:
                        yield from made(shard)
                        shard = Shard()
                    shard.open(id, position, (h1, h2), last, (leaves, kept))
                else:
                    shard.add((h1, h2), words, last)
        if shard.ids:
            yield from made(shard)

    columns = ["conv_id", "block", "position", "h1", "h2", "words", "last", "open", "leaves", "saved"]
    laid_out = pieces.repartitionByRange("conv_id", "block")
    laid_out = laid_out.sortWithinPartitions("conv_id", "block", F.desc("open"), "position").select(*columns)
    kinds = {pa.int64(): "bigint", pa.binary(): "binary"}
    return laid_out.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's end list, from its shards' lists in ascending order.

    A digest is one chain over its text, so the lists of a node pass through one task, eight bytes a
    conversation and a row a shard; the task holds one shard's list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for n1, n2, _, raw in zip(*(c.to_pylist() for c in batch.columns)):
                text = ",".join(map(str, np.frombuffer(raw, np.int64).tolist())).encode()
                if (n1, n2) == node:
                    digest.update(b"," + text)
                    continue
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (n1, n2), hashlib.sha256(text)
            if done:
                yield _digest_batch(done)
        if node is not None:
            yield _digest_batch([(*node, digest.hexdigest())])

    laid_out = ends.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first_end").select("n1", "n2", "first_end", "ends")
    return laid_out.mapInArrow(run, "n1 bigint, n2 bigint, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["n1", "n2", "ends_sha256"])


_NODE = ["n1", "n2"]


def trie(turns: DataFrame) -> DataFrame:
    """The prefix trie of conversations given as ``conv_id, position, name, words, n_turns``.

    Every conversation has a row at position 0 (see ``rebuilt``).  One row per node: conv_id (smallest
    member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  No conversations, no nodes.
    """
    pieces = saved(_pieces(turns), "pieces")
    nothing = F.lit(0).cast("bigint")
    parts = saved(_walked(pieces.withColumns({"leaves": nothing, "saved": nothing}), _counted, _COUNTED), "parts")
    nodes = parts.groupBy(*_NODE).agg(
        *[F.first(name).alias(name) for name in ("depth", "p1", "p2", "words")],
        F.min("conv_id").alias("conv_id"),
        F.sum("members").alias("n_convs"),
    )
    nodes = saved(nodes, "nodes")
    below = nodes.where("p1 is not null").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2"))
    nodes = nodes.join(below.agg(F.count("*").alias("n_children")), _NODE, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumns(
        {"leaf": (F.col("n_children") == 0).cast("bigint"), "saving": (F.col("n_convs") - 1) * F.col("words")}
    )
    nodes = saved(nodes, "nodes")

    # What each conversation owns, and what it owns above each of its nodes.
    owned = nodes.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"))
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    blocks = nodes.groupBy("conv_id", block).agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id", "block",
        F.coalesce(F.sum("leaves").over(earlier), nothing).alias("leaves_above"),
        F.coalesce(F.sum("saved").over(earlier), nothing).alias("saved_above"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = nodes.withColumn("block", block).withColumns(
        {
            "leaves_before": F.coalesce(F.sum("leaf").over(inside), nothing),
            "saved_before": F.coalesce(F.sum("saving").over(inside), nothing),
        }
    )
    placed = placed.join(blocks, ["conv_id", "block"])

    weighted = pieces.join(owned, "conv_id", "left").fillna(0, ["leaves", "saved"])
    sums = _walked(weighted, _summed, _SUMMED).groupBy(*_NODE)
    sums = sums.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    digests = _digests(parts.where("ends is not null"))
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = placed.join(sums, _NODE).join(digests, _NODE, "left").join(parents, ["p1", "p2"], "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves") - F.col("leaves_above") - F.col("leaves_before")).alias("n_leaves"),
        (F.col("saved") - F.col("saved_above") - F.col("saved_before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
